"""Benchmark decontamination with a generalised suffix automaton of the benchmark's items.

The automaton of all items' normalised words is built once and sent to the tasks; documents stream
their words through it, and after each word the length of the longest matching stretch is known. A
stretch of ``WINDOW`` words is a hit, as is a whole item of fewer words. Documents are never shuffled.

A benchmark too large for one automaton is cut into slices. Then one pass over the documents looks up hashes
of their windows among those of all items, 8 bytes each; only the few documents with such a window stream
through the slices' automata, whatever the number of slices.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.common import (
    LONG, TEXT, free_name, rows_of, ships_by_value, struct_of, text_bytes,
)
from plumbline.session import materialize

WINDOW = 10
# Bytes of item texts per automaton (about 400 bytes of memory for each); more items are
# matched slice by slice.
SLICE_BYTES = 1 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)
# Word bytes: A-Z lower-cased, other ASCII but letters and digits becomes space.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256))
# ``rest`` is the text without the spans, where that is asked for and there are any.
HITS = struct_of(
    n_words=LONG, spans=rows_of(begin=T.IntegerType(), end=T.IntegerType()), items=T.ArrayType(TEXT),
    rest=TEXT)
_SPANS = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))


@dataclass
class Automaton:
    """Suffix automaton over word numbers (from 1); state 0 is the start."""

    window: int
    words: dict[bytes, int] = field(default_factory=dict)
    follow: list[dict[int, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    longest: list[int] = field(default_factory=lambda: [0])
    # By state: the state of its strings' last ``window`` words (-1: shorter).
    tail: list[int] = field(default_factory=list)
    # Items by the state of a window; (length, item) of whole short items that end in a state.
    items: dict[int, set[str]] = field(default_factory=dict)
    short: dict[int, set[tuple[int, str]]] = field(default_factory=dict)
    shortest: int = 0

    def _state(self, longest: int, follow: dict[int, int], link: int) -> int:
        self.longest.append(longest)
        self.follow.append(follow)
        self.link.append(link)
        return len(self.link) - 1

    def _extend(self, last: int, word: int) -> int:
        """State of the string of ``last`` followed by ``word``."""
        known = self.follow[last].get(word)
        if known is not None and self.longest[known] == self.longest[last] + 1:
            return known
        if known is None:
            state = self._state(self.longest[last] + 1, {}, 0)
            at = last
            while at >= 0 and word not in self.follow[at]:
                self.follow[at][word] = state
                at = self.link[at]
            if at < 0:
                return state
            target = self.follow[at][word]
            if self.longest[target] == self.longest[at] + 1:
                self.link[state] = target
            else:
                self.link[state] = self._split(at, word, target)
            return state
        return self._split(last, word, known)

    def _split(self, at: int, word: int, target: int) -> int:
        """Give the strings that reach ``target`` from ``at`` a state of their own."""
        copy = self._state(self.longest[at] + 1, dict(self.follow[target]), self.link[target])
        self.link[target] = copy
        while at >= 0 and self.follow[at].get(word) == target:
            self.follow[at][word] = copy
            at = self.link[at]
        return copy

    def stream(self, words) -> Iterator[tuple[int, int]]:
        """State and length of the longest match after each word number."""
        state = length = 0
        for word in words:
            while state and word not in self.follow[state]:
                state = self.link[state]
                length = self.longest[state]
            after = self.follow[state].get(word)
            if after is None:
                state = length = 0
            else:
                state, length = after, length + 1
            yield state, length


def build_automaton(items: list[tuple[str, bytes]], window: int = WINDOW) -> Automaton:
    """Automaton of (item id, text); items without words are left out."""
    made = Automaton(window)
    numbered = []
    for item, text in items:
        words = text.translate(_FOLD).split()
        if words:
            numbered.append((item, [made.words.setdefault(w, len(made.words) + 1) for w in words]))
    for _, numbers in numbered:
        state = 0
        for word in numbers:
            state = made._extend(state, word)
    made.tail = [-1] * len(made.link)
    for state in sorted(range(1, len(made.link)), key=made.longest.__getitem__):
        if made.longest[state] >= window:
            above = made.link[state]
            made.tail[state] = made.tail[above] if made.longest[above] >= window else state
    own: dict[int, set[tuple[int, str]]] = {}
    for item, numbers in numbered:
        for state, length in made.stream(numbers):
            if length >= window:
                made.items.setdefault(made.tail[state], set()).add(item)
        if len(numbers) < window:
            own.setdefault(state, set()).add((len(numbers), item))
    # What ends in a state's suffixes ends in the state.
    for state in sorted(range(1, len(made.link)), key=made.longest.__getitem__):
        ends = own.get(state, set()) | made.short.get(made.link[state], set())
        if ends:
            made.short[state] = ends
    made.shortest = min((min(len(n), window) for _, n in numbered), default=0)
    return made


def find_hits(made: Automaton, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
    """Merged word spans (begin, end exclusive) of a text inside some window, and the items hit."""
    spans: list[list[int]] = []
    found: set[str] = set()
    if not made.shortest or len(words) < made.shortest:
        return [], found
    get = made.words.get
    numbers = np.fromiter((get(w, 0) for w in words), np.int64, len(words))
    # Only runs of benchmark words long enough to hold a window are streamed.
    edges = np.flatnonzero(np.diff(np.concatenate(([0], (numbers > 0).view(np.int8), [0]))))
    for begin, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
        if end - begin < made.shortest:
            continue
        for at, (state, length) in enumerate(made.stream(numbers[begin:end].tolist()), begin + 1):
            reach = 0
            if length >= made.window:
                reach = made.window
                found |= made.items[made.tail[state]]
            for n, item in made.short.get(state, ()):
                if n <= length:
                    reach = max(reach, n)
                    found.add(item)
            if reach:
                lo = at - reach
                while spans and spans[-1][1] >= lo:  # a short hit may end inside a longer one
                    lo = min(lo, spans.pop()[0])
                spans.append([lo, at])
    return [(a, b) for a, b in spans], found


def hits_udf(made: Automaton, cut_text: bool = False):
    @F.arrow_udf(HITS)
    def hits(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            yield column_hits(made, column, cut_text)
    # What is cut depends on the hits twice, as a filter and as a text. Spark would copy the function into
    # both and stream every text through two workers a task; what may vary it evaluates once.
    return hits.asNondeterministic() if cut_text else hits


def column_hits(made: Automaton, column: pa.Array, cut_text: bool) -> pa.Array:
    run, bounds = text_bytes(column)
    counts, spans, items, rests = [], [], [], []
    for a, b in zip(bounds, bounds[1:]):
        text = bytes(run[a:b])
        words = text.translate(_FOLD).split()
        where, found = find_hits(made, words)
        counts.append(len(words))
        spans.append([{"begin": x, "end": y} for x, y in where])
        items.append(sorted(found))
        rests.append(without_words(text, where).decode(errors="replace") if cut_text and where else None)
    return pa.StructArray.from_arrays(
        [pa.array(counts, pa.int64()), pa.array(spans, _SPANS), pa.array(items, pa.list_(pa.string())),
         pa.array(rests, pa.string())], ["n_words", "spans", "items", "rest"])


def find_contamination(
    docs: DataFrame, items: DataFrame, *, window: int = WINDOW, text: str = "text", into: str = "hits",
    item_id: str = "item_id", item_text: str = "text", slice_bytes: int = SLICE_BYTES,
    cut_text: bool = False,
) -> DataFrame:
    """``docs`` with a column ``into``: n_words, merged word spans hit, the ids of the items hit, and
    with ``cut_text`` the rest of a text that is hit.

    Null and empty texts have no words; items without words hit nothing; without items nothing is hit.
    An item may be listed several times. Rows of ``docs`` come back once each. The items are collected
    in slices of about ``slice_bytes``; beyond one slice only documents that may hold a window pass through
    every slice.
    """
    slim = items.select(F.col(item_id).cast("string").alias("item"), F.col(item_text).alias("text")) \
        .where(F.col("text").isNotNull()).distinct()
    total = slim.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    slices = max(1, -(-total // slice_bytes))
    part = F.pmod(F.xxhash64("item", "text"), F.lit(slices))
    if slices > 1:
        suspect = free_name(docs, "suspect")
        marked = materialize(docs.withColumn(suspect, windows_known(slim, window)(F.col(text))), "suspects")
        clean = marked.where(~F.col(suspect)["hit"]).withColumn(into, F.struct(
            F.col(suspect)["n_words"].alias("n_words"), *[
                (F.array() if c != "rest" else F.lit(None)).cast(HITS[c].dataType).alias(c)
                for c in ("spans", "items", "rest")])).drop(suspect)
        docs = marked.where(F.col(suspect)["hit"]).drop(suspect)
    out = docs
    for k in range(slices):
        rows = slim.where(part == k).collect()  # one slice, bounded in bytes
        made = build_automaton([(r["item"] or "", r["text"].encode()) for r in rows], window)
        found = hits_udf(made, cut_text and slices == 1)(F.col(text))
        if slices == 1:
            return out.withColumn(into, found)
        # Later passes add to what the earlier ones found.
        if k == 0:
            out = materialize(out.withColumn(into, found), "hits")
        else:
            more = free_name(out, "more")
            out = materialize(out.withColumn(more, found).withColumn(
                into, merge_hits(F.col(into), F.col(more))).drop(more), "hits")
    if cut_text:
        out = out.withColumn(into, F.col(into).withField("rest", cut_words(F.col(text), F.col(into)["spans"])))
    return out.unionByName(clean)


def _window_keys(numbers: np.ndarray, length: int) -> np.ndarray:
    """A hash of every window of word numbers; 0 for those with a word the benchmark has not."""
    n = max(0, len(numbers) - length + 1)
    keys, known = np.zeros(n, np.uint64), np.ones(n, bool)
    for j in range(length):
        keys = keys * _STEP + numbers[j:j + n].astype(np.uint64)
        keys ^= keys >> np.uint64(29)
        known &= numbers[j:j + n] > 0
    return np.where(known, keys | np.uint64(1), np.uint64(0))


def windows_known(items: DataFrame, window: int):
    """For a text: how many words it has, and whether it may hold a window of some item.

    The driver gets the items' distinct words and 8 bytes for each of their windows.
    """
    @F.arrow_udf(T.ArrayType(TEXT))
    def words_of(texts: pa.Array) -> pa.Array:
        return pa.array([[w.decode(errors="replace") for w in t.encode().translate(_FOLD).split()]
                         for t in texts.to_pylist()], pa.list_(pa.string()))

    worded = materialize(items.select(words_of(F.col("text")).alias("words")).where(F.size("words") > 0), "item-words")
    listed = worded.select(F.explode("words").alias("word")).distinct().orderBy("word").collect()
    numbers = {r["word"].encode(): n for n, r in enumerate(listed, 1)}
    sent = items.sparkSession.sparkContext.broadcast(numbers)

    @F.arrow_udf(rows_of(length=LONG, key=LONG))
    def keys_of(words: pa.Array) -> pa.Array:
        out = []
        for row in words.to_pylist():
            length = min(window, len(row))
            keys = _window_keys(np.array([sent.value[w.encode()] for w in row], np.int64), length)
            out.append([{"length": length, "key": k} for k in np.unique(keys).view(np.int64).tolist()])
        return pa.array(out, pa.list_(pa.struct([("length", pa.int64()), ("key", pa.int64())])))

    found = worded.select(F.inline(keys_of(F.col("words")))).distinct().toArrow()
    lengths = found.column("length").to_numpy()
    keys = found.column("key").to_numpy().view(np.uint64)
    tables = {int(n): np.sort(keys[lengths == n]) for n in np.unique(lengths)}
    shipped = items.sparkSession.sparkContext.broadcast(tables)

    @F.arrow_udf(struct_of(n_words=LONG, hit=T.BooleanType()))
    def known(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        get = sent.value.get
        for column in texts:
            run, bounds = text_bytes(column)
            counts, hits = [], []
            for a, b in zip(bounds, bounds[1:]):
                words = bytes(run[a:b]).translate(_FOLD).split()
                coded = np.fromiter((get(w, 0) for w in words), np.int64, len(words))
                counts.append(len(words))
                hits.append(any(_among(_window_keys(coded, n), table) for n, table in shipped.value.items()))
            yield pa.StructArray.from_arrays([pa.array(counts, pa.int64()), pa.array(hits, pa.bool_())],
                                             ["n_words", "hit"])
    return known


def _among(keys: np.ndarray, table: np.ndarray) -> bool:
    keys = keys[keys > 0]
    if not len(keys):
        return False
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return bool((table[at] == keys).any())


@F.arrow_udf(TEXT)
def cut_words(texts: pa.Array, spans: pa.Array) -> pa.Array:
    """Texts without the given word spans, null without spans."""
    run, bounds = text_bytes(texts)
    cuts = [[(c["begin"], c["end"]) for c in row] for row in spans.to_pylist()]
    return pa.array([without_words(bytes(run[a:b]), c).decode(errors="replace") if c else None
                     for a, b, c in zip(bounds, bounds[1:], cuts)], pa.string())


def merge_hits(one: Column, other: Column) -> Column:
    @F.arrow_udf(HITS)
    def merged(left: pa.Array, right: pa.Array) -> pa.Array:
        rows = []
        for a, b in zip(left.to_pylist(), right.to_pylist()):
            spans = []
            for s in sorted(a["spans"] + b["spans"], key=lambda s: (s["begin"], s["end"])):
                if spans and s["begin"] <= spans[-1]["end"]:
                    spans[-1]["end"] = max(spans[-1]["end"], s["end"])
                else:
                    spans.append(dict(s))
            rows.append({"n_words": a["n_words"], "spans": spans,
                         "items": sorted({*a["items"], *b["items"]}), "rest": None})
        return pa.array(rows, pa.struct([("n_words", pa.int64()), ("spans", _SPANS),
                                         ("items", pa.list_(pa.string())), ("rest", pa.string())]))
    return merged(one, other)


def hit_words(hits: Column) -> Column:
    """Words inside any occurrence of a window."""
    return F.aggregate(hits["spans"], F.lit(0).cast("long"),
                       lambda n, s: n + (s["end"] - s["begin"]).cast("long"))


def remove_contamination(
    docs: DataFrame, items: DataFrame, *, max_words: int = 200, max_coverage: float = 0.5,
    window: int = WINDOW, text: str = "text",
) -> DataFrame:
    """``docs`` without benchmark passages.

    A document goes if a passage is longer than ``max_words`` or if more than ``max_coverage`` of its
    words are hit; from the others the passages are cut out, with one space left in their place. Clean
    documents, null and empty texts are returned as they are.
    """
    found = free_name(docs, "found")
    hits = find_contamination(docs, items, window=window, text=text, into=found, cut_text=True)
    spans, n = F.col(found)["spans"], F.col(found)["n_words"]
    longest = F.coalesce(F.array_max(F.transform(spans, lambda s: s["end"] - s["begin"])), F.lit(0))
    clean = hits.where((longest <= max_words)
                       & (hit_words(F.col(found)) <= F.lit(max_coverage) * n))
    return clean.withColumn(text, F.when(F.size(spans) > 0, F.col(found)["rest"])
                            .otherwise(F.col(text))).drop(found)


def without_words(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the given word spans, one space in the place of each."""
    inside = np.frombuffer(text.translate(_FOLD), np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.concatenate(([0], inside.view(np.int8), [0]))))
    pieces, at = [], 0
    for begin, end in spans:
        pieces.append(text[at:int(edges[2 * begin])])
        at = int(edges[2 * end - 1])
    pieces.append(text[at:])
    return b" ".join(p.strip(b" ") for p in pieces).strip(b" ")


ships_by_value(__name__)
