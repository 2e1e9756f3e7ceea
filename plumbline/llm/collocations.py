"""Phrase collocations by top-order marginalisation.

Every word begins one window: itself and the next three words of its piece, padded. Only these longest
windows are counted, in one shuffle that keeps all windows with the same first two words together (those of
the few very frequent pairs are dealt further by their third word). There the counts of a window's pair,
triple and itself are known, and the window is cut after its longest prefix that is frequent enough. What is
left is little, and Spark's ROLLUP over (lang, w1, w2, w3, w4) sums ever shorter prefixes of it, which are
the counts of all shorter phrases.

Words are shuffled as numbers: a first pass counts all words, and the most frequent ones, at most
``VOCABULARY``, are numbered and sent to every task. Frequent words beyond that number travel as text;
rarer ones than asked for end a window, as no frequent phrase holds one. So counts are exact for any corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.common import LONG, TEXT, UPPER, ships_by_value, struct_of, text_bytes
from plumbline.session import materialize

ORDER = 4
LEAST_COUNT = 30
HELD_PERCENT = 80
SCORE_SCALE = 2_000_000
BEST = 2000
NO_LANG = "und"

# Words with a number, at most; longer ones than so many bytes travel as text (together: 20 MB at most).
VOCABULARY, LONGEST = 1 << 18, 64
# A pair that makes up so large a share of a part's words is reported, and of all words is hot.
REPORTED_SHARE, HOT_SHARE = 1 / 200, 1 / 500
HOT_SPLIT = 256
# Texts are worked on in parts of about so many bytes, which bounds the arrays, and words' first windows in
# tasks of so many on average.
PART_BYTES = 1 << 20
TASK_WORDS = 500_000

# Bytes: 0 belongs to a word, 1 ends a word, 2 ends a piece.
_CLASS_OF = np.zeros(256, np.uint8)
_CLASS_OF[[0x20, 0x09]] = 1
_CLASS_OF[np.frombuffer(b".,;:!?\x0A\x0B\x0C\x0D", np.uint8)] = 2
_LOWER_OF = np.arange(256, dtype=np.uint8)
_LOWER_OF[np.frombuffer(UPPER.encode(), np.uint8)] += 32

# Numbers in a window: no word, a word outside the vocabulary, then the vocabulary.
NOTHING, OTHER, FIRST = 0, 1, 2

WORDS = tuple(f"w{k}" for k in range(1, ORDER + 1))


class Part:
    """Words of some texts: local numbers by language, and which have a next word in their piece."""

    def __init__(self, texts: list[bytes], langs: np.ndarray):
        run = np.frombuffer(b"\n".join(texts), np.uint8)
        kind = _CLASS_OF[run]
        edges = np.flatnonzero(np.diff(np.concatenate(([False], kind == 0, [False])).view(np.int8)))
        begin, end = edges[::2], edges[1::2]
        self.n = len(begin)
        if not self.n:
            return
        data = _LOWER_OF[run[kind == 0]]
        offsets = np.concatenate(([0], np.cumsum(end - begin)))
        words = pa.LargeStringArray.from_buffers(self.n, pa.py_buffer(offsets), pa.py_buffer(data))
        coded = words.dictionary_encode()
        self.words, ids = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        starts = np.cumsum([0, *[len(t) + 1 for t in texts[:-1]]])
        text_no = np.searchsorted(starts, begin, side="right") - 1
        piece = np.cumsum(kind == 2, dtype=np.int32)[begin]
        self.follows = np.append(piece[1:] == piece[:-1], False)
        # Entries: distinct words of each language, in order of language and word number.
        self.entry_keys, self.entries = np.unique(
            langs.astype(np.int64)[text_no] * len(self.words) + ids, return_inverse=True)

    def entry_langs(self) -> np.ndarray:
        return self.entry_keys // len(self.words)

    def entry_words(self) -> pa.Array:
        return self.words.take(pa.array(self.entry_keys % len(self.words)))


def parts_of(texts: pa.Array, langs: pa.Array) -> Iterator[tuple[Part, pa.Array]]:
    """The words of a batch of texts in parts, with the languages their numbers stand for."""
    if isinstance(langs, pa.ChunkedArray):
        langs = langs.combine_chunks()
    coded = langs.dictionary_encode()
    names, numbers = coded.dictionary, coded.indices.to_numpy()
    run, bounds = text_bytes(texts)
    bounds = bounds.tolist()
    first = 0
    for i in range(len(numbers)):
        if i + 1 == len(numbers) or bounds[i + 2] - bounds[first] > PART_BYTES:
            part = Part([bytes(run[bounds[j]:bounds[j + 1]]) for j in range(first, i + 1)], numbers[first:i + 1])
            if part.n:
                yield part, names
            first = i + 1


def _counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    values = np.sort(values)
    heads = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else values
    return values[heads], np.diff(np.append(heads, len(values)))


def word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, w1, w2, n): the words of every part with their counts, and with w2 its very frequent pairs."""
    for batch in batches:
        for part, names in parts_of(batch.column(0), batch.column(1)):
            langs, words = names.take(pa.array(part.entry_langs())), part.entry_words()
            n = np.bincount(part.entries, minlength=len(words))
            at = np.flatnonzero(part.follows)
            pairs, often = _counted(part.entries[at] * len(words) + part.entries[at + 1])
            hot = often >= max(2.0, part.n * REPORTED_SHARE)
            first, second = pa.array(pairs[hot] // len(words)), pa.array(pairs[hot] % len(words))
            yield pa.RecordBatch.from_arrays([
                pa.concat_arrays([langs, langs.take(first)]).cast(pa.string()),
                pa.concat_arrays([words, words.take(first)]).cast(pa.string()),
                pa.concat_arrays([pa.nulls(len(words), words.type), words.take(second)]).cast(pa.string()),
                pa.array(np.concatenate([n, often[hot]]).astype(np.int64))], ["lang", "w1", "w2", "n"])


@dataclass
class Vocabulary:
    """The numbered words as sorted digests of (language, word), and the numbers of hot pairs.

    ``whole``: it holds every word that is frequent enough, so all others end a window. ``total``: all words.
    """

    high: np.ndarray
    low: np.ndarray
    numbers: np.ndarray
    langs: pa.Array
    words: pa.Array
    hot: np.ndarray
    whole: bool
    total: int

    @staticmethod
    def digests(langs: pa.Array, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        both = [xxhash.xxh3_128_intdigest(w, seed=s) for w, s in zip(
            words.cast(pa.large_binary()).to_pylist(), _seeds(langs))]
        return (np.fromiter((d >> 64 for d in both), np.uint64, len(both)),
                np.fromiter((d & 0xFFFFFFFFFFFFFFFF for d in both), np.uint64, len(both)))

    @classmethod
    def of(cls, words: list[tuple[str, str]], pairs: list[tuple[str, str, str]], whole: bool,
           total: int) -> Vocabulary:
        langs, texts = (pa.array([w[k] for w in words], pa.string()) for k in (0, 1))
        high, low = cls.digests(langs, texts)
        order = np.argsort(high, kind="stable")
        found = cls(high[order], low[order], order + FIRST, langs, texts, np.zeros(0, np.int64), whole,
                    total)
        if pairs:
            lang, *sides = (pa.array([p[k] for p in pairs], pa.string()) for k in range(3))
            first, second = (found.lookup(lang, side) for side in sides)
            found.hot = np.sort(_pair(first, second))
        return found

    def lookup(self, langs: pa.Array, words: pa.Array) -> np.ndarray:
        """Numbers of words; OTHER or, where that proves them rare, NOTHING for those without one."""
        missing = NOTHING if self.whole else OTHER
        if not len(self.high):
            return np.full(len(words), missing, np.int64)
        high, low = self.digests(langs, words)
        at = np.minimum(np.searchsorted(self.high, high), len(self.high) - 1)
        return np.where((self.high[at] == high) & (self.low[at] == low), self.numbers[at], missing)


def _seeds(langs: pa.Array) -> Iterator[int]:
    coded = langs.dictionary_encode()
    seeds = [xxhash.xxh3_64_intdigest(lang.encode()) for lang in coded.dictionary.to_pylist()]
    return (seeds[i] for i in coded.indices.to_pylist())


def _pair(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return (first << 32) | second


def window_rows(part: Part, names: pa.Array, known: Vocabulary) -> pa.RecordBatch:
    """(front, back, split, lang, rest, n): distinct windows of a part.

    ``front`` holds the numbers of the first two words, ``back`` those of the others; ``lang`` and ``rest``
    (the words themselves, joined) are null but for windows with words outside the vocabulary. ``split`` is
    above 0 for hot pairs (by the third word) and below for pairs with a word outside (by that word).
    """
    langs, words = names.take(pa.array(part.entry_langs())), part.entry_words()
    numbers = known.lookup(langs, words)
    entry = part.entries
    # Lead columns: the words from here on, NOTHING from the first break.
    columns = [numbers[entry]]
    unbroken = columns[0] != NOTHING
    for k in range(1, ORDER):
        lead = np.zeros(part.n, np.int64)
        lead[:part.n - k] = columns[0][k:]
        reach = np.zeros(part.n, bool)
        reach[:part.n - k + 1] = part.follows[k - 1:]
        unbroken = unbroken & reach & (lead != NOTHING)
        columns.append(np.where(unbroken, lead, NOTHING))
    begins = np.flatnonzero(columns[0] != NOTHING)
    columns = [c[begins] for c in columns]
    front, back = _pair(columns[0], columns[1]), _pair(columns[2], columns[3])
    odd = np.zeros(len(begins), bool)
    for c in columns:
        odd |= c == OTHER
    at = np.flatnonzero(~odd)
    order = at[np.lexsort((back[at], front[at]))]
    f, b = front[order], back[order]
    heads = np.flatnonzero(np.concatenate(([True], (f[1:] != f[:-1]) | (b[1:] != b[:-1])))) if len(order) else order
    n = np.diff(np.append(heads, len(order)))
    odd = np.flatnonzero(odd)
    f, b = np.concatenate([f[heads], front[odd]]), np.concatenate([b[heads], back[odd]])
    split = np.where(np.isin(f, known.hot), 1 + (b >> 32) % HOT_SPLIT, 0).astype(np.int64)
    texts = words.to_pylist() if len(odd) else []
    rest, lang = [], langs.take(pa.array(entry[begins[odd]])).cast(pa.string())
    for place, i in enumerate(odd.tolist(), len(heads)):
        others = [texts[entry[begins[i] + k]] for k in range(ORDER) if columns[k][i] == OTHER]
        rest.append(" ".join(others))
        in_front = int(columns[0][i] == OTHER) + int(columns[1][i] == OTHER)
        if in_front:  # as many keys as there are words
            split[place] = -1 - (xxhash.xxh3_64_intdigest(" ".join(others[:in_front])) >> 1)
    return pa.RecordBatch.from_arrays([
        pa.array(f), pa.array(b), pa.array(split),
        pa.concat_arrays([pa.nulls(len(heads), pa.string()), lang]),
        pa.concat_arrays([pa.nulls(len(heads), pa.string()), pa.array(rest, pa.string())]),
        pa.array(np.concatenate([n, np.ones(len(odd))]).astype(np.int64))],
        ["front", "back", "split", "lang", "rest", "n"])


def windows_of(shared):
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, names in parts_of(batch.column(0), batch.column(1)):
                yield window_rows(part, names, shared.value)
    return windows


def spelled_out(shared):
    """Windows of numbers as windows of words."""
    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            numbers = np.stack([batch.column(w).to_numpy() for w in WORDS])
            columns = [known.words.take(pa.array(np.maximum(c - FIRST, 0), mask=c < FIRST)) for c in numbers] \
                if len(known.words) else [pa.nulls(batch.num_rows, pa.string())] * ORDER
            lang = pc.coalesce(batch.column("lang"), known.langs.take(pa.array(np.maximum(numbers[0] - FIRST, 0)))
                               if len(known.langs) else batch.column("lang"))
            odd = np.flatnonzero((numbers == OTHER).any(axis=0))
            if len(odd):
                texts = [c.to_pylist() for c in columns]
                for i in odd.tolist():
                    words = iter(batch.column("rest")[i].as_py().split(" "))
                    for k in range(ORDER):
                        if numbers[k, i] == OTHER:
                            texts[k][i] = next(words)
                columns = [pa.array(t, pa.string()) for t in texts]
            yield pa.RecordBatch.from_arrays([lang, *columns, batch.column("n")], ["lang", *WORDS, "n"])
    return spell


def read_vocabulary(counts: DataFrame, least: int) -> Vocabulary:
    """From the counts of words and reported pairs: at most VOCABULARY words, 1 / HOT_SHARE pairs."""
    words = counts.where(F.col("w2").isNull() & (F.col("n") >= least))
    n_words = words.count()
    listed = words.where(F.octet_length("w1") <= LONGEST).orderBy(F.col("n").desc(), "lang", "w1") \
        .limit(VOCABULARY).select("lang", "w1").collect()
    total = counts.where(F.col("w2").isNull()).agg(F.sum("n")).first()[0] or 0
    pairs = counts.where(F.col("w2").isNotNull() & (F.col("n") >= max(least, total * HOT_SHARE))) \
        .select("lang", "w1", "w2").collect()
    listed = [tuple(r) for r in listed]
    named = set(listed)
    return Vocabulary.of(listed, [tuple(p) for p in pairs if (p[0], p[1]) in named and (p[0], p[2]) in named],
                         n_words == len(listed), total)


def frequent_windows(texts: DataFrame, known: Vocabulary, least: int) -> DataFrame:
    """Rows (lang, w1 .. w4, n): all windows, each cut after its longest prefix found ``least`` times."""
    shared = texts.sparkSession.sparkContext.broadcast(known)
    raw = texts.mapInArrow(windows_of(shared), struct_of(
        front=LONG, back=LONG, split=LONG, lang=TEXT, rest=TEXT, n=LONG))
    counted = raw.repartition(-(-known.total // TASK_WORDS) or 1, "front", "split").groupBy("front", "split", "back", "lang", "rest").agg(
        F.sum("n").alias("n"))
    number = lambda of, k: F.shiftright(of, 32) if k == 0 else of.bitwiseAND(F.lit(0xFFFFFFFF))
    numbers = [number(F.col(side), k) for side in ("front", "back") for k in (0, 1)]
    named = counted
    others = F.split(F.coalesce("rest", F.lit("")), " ")
    counts_of_other = [F.lit(0)]
    for k, value in enumerate(numbers):
        named = named.withColumn(f"n{k}", value)
        counts_of_other.append(counts_of_other[-1] + (F.col(f"n{k}") == OTHER).cast("int"))
    head = lambda k: F.when(  # noqa: E731  the words outside the vocabulary among the first k
        F.col("rest").isNotNull() & (counts_of_other[k] > 0),
        F.array_join(F.slice(others, F.lit(1), counts_of_other[k]), " "))
    # The number of a first word tells its language; one outside the vocabulary needs it beside it.
    named = named.withColumn("lang", F.when(F.col("n0") == OTHER, F.col("lang"))) \
        .withColumn("rest1", head(1)).withColumn("rest2", head(2)).withColumn("rest3", head(3))
    pair = Window.partitionBy("front", "split", "lang", "rest2")
    triple = Window.partitionBy("front", "split", "lang", "rest2", "n2", "rest3")
    # A hot pair is frequent, whatever share of it is here.
    two = (F.col("n1") > 0) & ((F.col("split") > 0) | (F.col("f2") >= least))
    three = two & (F.col("n2") > 0) & (F.col("f3") >= least)
    four = three & (F.col("n3") > 0) & (F.col("n") >= least)
    cut = named.withColumn("f2", F.sum("n").over(pair)).withColumn("f3", F.sum("n").over(triple)).select(
        "lang", F.col("n0").alias("w1"), F.when(two, F.col("n1")).otherwise(NOTHING).alias("w2"),
        F.when(three, F.col("n2")).otherwise(NOTHING).alias("w3"),
        F.when(four, F.col("n3")).otherwise(NOTHING).alias("w4"),
        F.when(four, F.col("rest")).when(three, F.col("rest3")).when(two, F.col("rest2"))
        .otherwise(F.col("rest1")).alias("rest"), "n")
    kind = T.StructType([T.StructField(c, TEXT) for c in ("lang", *WORDS)] + [T.StructField("n", LONG)])
    return cut.groupBy("lang", *WORDS, "rest").agg(F.sum("n").alias("n")).mapInArrow(spelled_out(shared), kind)


def count_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST_COUNT) -> DataFrame:
    """Rows (lang, ``size``, w1 .. w4, f): counts of all phrases of 1 to 4 words that reach ``least``, and
    with size 0 the number of all words of each language.

    Null texts are empty, a null language is ``und``. Repeated rows count as often as they come. An empty
    table has no rows. Other columns are ignored.
    """
    texts = docs.select(F.col(text).cast("string").alias("text"),
                        F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANG)).alias("lang"))
    counts = materialize(texts.mapInArrow(word_rows, struct_of(lang=TEXT, w1=TEXT, w2=TEXT, n=LONG))
                         .groupBy("lang", "w1", "w2").agg(F.sum("n").alias("n")), "word-counts")
    windows = frequent_windows(texts, read_vocabulary(counts, least), least)
    size = F.lit(ORDER) - F.floor(F.log2(F.grouping_id() + 1)).cast("int")
    sums = windows.rollup("lang", *WORDS).agg(F.sum("n").alias("f"), size.alias("size"))
    last = F.element_at(F.array(*WORDS), F.greatest(F.col("size"), F.lit(1)))
    totals = counts.where(F.col("w2").isNull()).groupBy("lang").agg(F.sum("n").alias("f"))
    return sums.where((F.col("size") > 0) & last.isNotNull() & (F.col("f") >= least)).unionByName(
        totals.withColumn("size", F.lit(0)), allowMissingColumns=True)


def _wide(number: Column) -> Column:
    return number.cast("decimal(38,0)")


def mine_collocations(
    docs: DataFrame, *, text: str = "text", lang: str = "lang", least: int = LEAST_COUNT,
    held_percent: int = HELD_PERCENT, best: int = BEST,
) -> DataFrame:
    """The best phrases of every language: lang, rank, phrase, a, l, r, n, score.

    Phrases of 2 to 4 words found at least ``least`` times (a). The lowest-scoring cut into two parts
    found l and r times gives the score floor(2,000,000 a / (l + r)); of equal cuts the first. Phrases
    inside a longer frequent one found at least ``held_percent`` % as often are dropped. n counts all
    words of the language. Ranks go by score, then a, then the phrase. Null texts are empty, null
    languages ``und``, repeated rows count each time; an empty table gives an empty result.
    """
    counts = materialize(count_phrases(docs, text, lang, least), "phrase-counts")
    phrase = F.concat_ws(" ", *[F.when(F.col("size") >= k + 1, F.col(w)) for k, w in enumerate(WORDS)])
    found = counts.where(F.col("size") > 0).select(
        "lang", phrase.alias("phrase"), "size", F.array(*WORDS).alias("words"), "f")
    longer = found.where(F.col("size") > 1)
    joined = lambda begin, length: F.array_join(
        F.slice("words", begin, length), " ")
    # Cuts: each side's count, one row per phrase and cut, put together again per phrase.
    cuts = longer.select("lang", "phrase", "size", "words", "f", F.explode(
        F.sequence(F.lit(1), F.col("size") - 1)).alias("k")) \
        .withColumn("front", joined(F.lit(1), F.col("k"))) \
        .withColumn("rest", joined(F.col("k") + 1, F.col("size") - F.col("k")))
    side = lambda name, f: found.select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    cuts = cuts.join(side("front", "l"), ["lang", "front"]).join(side("rest", "r"), ["lang", "rest"])
    score = F.call_function("div", _wide(F.col("f")) * F.lit(SCORE_SCALE).cast("decimal(7,0)"),
                            _wide(F.col("l")) + _wide(F.col("r")))
    scored = cuts.withColumn("score", score.cast("long")).groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"), F.first("f").alias("a"))
    inside = longer.where(F.col("size") > 2).select("lang", "f", F.explode(F.flatten(F.transform(
        F.sequence(F.lit(2), F.col("size") - 1), lambda length: F.transform(
            F.sequence(F.lit(1), F.col("size") - length + 1),
            lambda begin: joined(begin, length))))).alias("phrase")) \
        .groupBy("lang", "phrase").agg(F.max("f").alias("around"))
    held = F.col("around").isNotNull() & (
        _wide(F.col("around")) * F.lit(100).cast("decimal(3,0)")
        >= _wide(F.col("a")) * F.lit(held_percent).cast("decimal(3,0)"))
    words = counts.where(F.col("size") == 0).select("lang", F.col("f").alias("n"))
    order = Window.partitionBy("lang").orderBy(
        F.col("cut.score").desc(), F.col("a").desc(), F.col("phrase").asc())
    ranked = scored.join(inside, ["lang", "phrase"], "left").where(~held) \
        .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    return ranked.join(words, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"),
        F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))


ships_by_value(__name__)
