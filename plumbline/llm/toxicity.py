"""Toxicity by compression distance.

Every window of a text is compressed with two zstandard dictionaries. Only the ordinary one is trained by
zstandard. For toxic text that training is replaced: its dictionary is up to ``TOXIC_BYTES`` of stretches
of words, picked by how much more frequent their 5-grams are in toxic text (``TIMES``, ``LEAST``), as raw
content in front of the ordinary dictionary. So both cost an ordinary window the same and a window with
toxic wording is shorter with the toxic one. The lengths' differences over a whole text are summed up in a few
figures, and a calibration fitted on other labelled texts turns them into a score from 0 to 1.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import DOUBLE, free_name, ships_by_value, text_bytes
from plumbline.session import materialize

# Bounded training sample: labelled rows of either class, bytes of a text that may be in it, and bytes
# of either class together.
TOXIC_ROWS, ORDINARY_ROWS, TEXT_BYTES, CLASS_BYTES = 1200, 2000, 1 << 16, 5 << 20
WINDOW, MIN_MATCH = 64, 5
BASE_BYTES, TOXIC_BYTES = 4096, 4096
# A stretch is telling if its bytes come in so many surroundings, so many times as often per byte; the
# calibration texts decide between the given factors.
GRAM, AROUND, LEAST, TIMES = 5, 6, 8, (8.0, 60.0)
# Windows compressed in one call, and bytes of the texts that are worked on together.
CALL, PART_BYTES = 20_000, 1 << 20
_LETTERS = np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.uint64)


def windows_of(text: bytes) -> list[bytes]:
    """The whole text in windows of at most WINDOW bytes, cut at spaces where there are any."""
    out, at, n = [], 0, len(text)
    while at < n:
        end = at + WINDOW
        if end < n:
            space = text.rfind(b" ", at + WINDOW // 2, end)
            end = space if space > 0 else end
        out.append(text[at:end])
        at = end
    return out


def compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    settings = zstandard.ZstdCompressionParameters.from_level(
        3, window_log=15, hash_log=14, chain_log=14, search_log=4, min_match=MIN_MATCH,
        strategy=zstandard.STRATEGY_GREEDY, write_checksum=False, write_content_size=False,
        write_dict_id=False)
    return zstandard.ZstdCompressor(compression_params=settings, dict_data=zstandard.ZstdCompressionDict(
        dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT))


def lengths(press: zstandard.ZstdCompressor, windows: list[bytes]) -> np.ndarray:
    out = []
    for at in range(0, len(windows), CALL):
        done = press.multi_compress_to_buffer(windows[at:at + CALL], threads=0)
        out += [len(done[i]) for i in range(len(done))]
    return np.array(out, np.int64)


# --- training ------------------------------------------------------------------------------------

def _names(codes: np.ndarray, length: int) -> np.ndarray:
    names, reach = _LETTERS[codes], 1
    while reach < length:
        step = min(reach, length - reach)
        names = names[:-step] * np.uint64(0x9E3779B97F4A7C15) + names[step:]
        names ^= names >> np.uint64(29)
        names *= np.uint64(0xC2B2AE3D27D4EB4F)
        names ^= names >> np.uint64(32)
        reach += step
    return names


def _gram_counts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, int]:
    """Grams and how many different surroundings each has, so copies of a text count once."""
    gap = bytes(AROUND + GRAM)
    run = np.frombuffer(gap.join([b"", *texts, b""]), np.uint8)
    wide = _names(run, GRAM + 2 * AROUND)
    places = len(wide)
    first = np.unique(wide, return_index=True)[1]
    del wide
    grams, counts = np.unique(_names(run, GRAM)[AROUND:AROUND + places][first], return_counts=True)
    return grams, counts, len(first)


def telling_grams(toxic: list[bytes], ordinary: list[bytes]) -> list[np.ndarray]:
    """For each of TIMES the grams that are that much more frequent in toxic text."""
    grams, seen, n_toxic = _gram_counts(toxic)
    others, other_counts, n_other = _gram_counts(ordinary)
    at = np.minimum(np.searchsorted(others, grams), len(others) - 1)
    elsewhere = np.where(others[at] == grams, other_counts[at], 0)
    share = (seen / n_toxic) / ((elsewhere + 0.5) / n_other)
    return [grams[(seen >= LEAST) & (share > times)] for times in TIMES]


def telling_stretches(texts: list[bytes], grams: np.ndarray) -> Counter:
    """Stretches covered by telling grams inside words, with the spaces around them, and in how many
    texts their words are."""
    words = Counter(w for t in texts for w in {w.strip(b".,;:!?") for w in t.split()})
    known = sorted(words)
    padded = [b" " + w + b" " for w in known]
    run = b"".join(padded)
    found: Counter = Counter()
    if len(run) < GRAM:
        return found
    ends = np.cumsum([len(p) for p in padded])
    hit = np.isin(_names(np.frombuffer(run, np.uint8), GRAM), grams)
    word_of = np.searchsorted(ends, np.arange(len(hit)), side="right")
    hit &= np.arange(len(hit)) + GRAM <= ends[word_of]  # inside one word
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
        found[run[a:b + GRAM - 1]] += words[known[word_of[a]]]
    return found


def train_dictionaries(toxic: list[bytes], ordinary: list[bytes]) -> tuple[list[bytes], bytes]:
    """The toxic dictionary's content for each of TIMES, and the ordinary one's."""
    samples = [w for t in ordinary for w in windows_of(t)]
    try:
        base = zstandard.train_dictionary(BASE_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: the text itself is the dictionary
        base = b"".join(samples)[:BASE_BYTES]
    base = base or b" " * 8
    choices = telling_grams(toxic, ordinary) if toxic and ordinary else [np.zeros(0, np.uint64)]
    made = []
    for grams in choices:
        found = telling_stretches(toxic, grams)
        # The most frequent last, nearest to the text.
        stretches = sorted(found, key=lambda s: (found[s], s))
        made.append(b"".join(stretches)[-TOXIC_BYTES:] + base)
    return made, base


@dataclass
class ToxicModel:
    toxic: bytes
    ordinary: bytes
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def scores(self, figures: np.ndarray) -> np.ndarray:
        z = ((figures - self.mean) / self.scale) @ self.weights[1:] + self.weights[0]
        return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def figures_of(gains: np.ndarray) -> list[float]:
    """What a text's window differences come to; all zero for an empty text."""
    if not len(gains):
        return [0.0] * 7
    top = np.sort(gains)[::-1]
    padded = np.concatenate((top[:8], np.zeros(max(0, 8 - len(top)))))
    return [float(min(top[0], 8)), float(np.minimum(padded[:2], 8).mean()), float(np.minimum(padded[:4], 8).mean()),
            float(np.minimum(gains, 8).mean()), float((gains >= 2).mean()),
            float(np.log1p((gains >= 2).sum())), float(np.log1p((gains >= 4).sum()))]


def text_figures(texts: list[bytes], toxic: bytes, ordinary: bytes) -> np.ndarray:
    """Figures of texts (lower-cased here), compressed in large calls."""
    pieces = [windows_of(t.lower()) for t in texts]
    every = [w for p in pieces for w in p]
    gains = lengths(compressor(ordinary), every) - lengths(compressor(toxic), every) if every \
        else np.zeros(0, np.int64)
    ends = np.cumsum([len(p) for p in pieces])
    return np.array([figures_of(gains[end - len(p):end]) for p, end in zip(pieces, ends)]).reshape(len(texts), 7)


def calibrate(figures: np.ndarray, labels: np.ndarray, rounds: int = 60) -> tuple[np.ndarray, ...]:
    """Logistic regression by Newton steps with a small ridge."""
    mean, scale = figures.mean(axis=0), figures.std(axis=0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    design = np.column_stack([np.ones(len(figures)), (figures - mean) / scale])
    weights = np.zeros(design.shape[1])
    ridge = np.diag([1e-6] + [1.0] * figures.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
        step = np.linalg.solve(design.T @ (design * (p * (1 - p))[:, None]) + ridge,
                               design.T @ (labels - p) - ridge @ weights)
        weights += step
        if np.abs(step).max() < 1e-8:
            break
    return mean, scale, weights


def fit(toxic: list[bytes], ordinary: list[bytes]) -> ToxicModel:
    """Dictionaries from two of three texts of each class, the calibration from the others."""
    toxic, ordinary = ([t.lower() for t in dict.fromkeys(texts)] for texts in (toxic, ordinary))
    rest = lambda texts: ([t for i, t in enumerate(texts) if i % 3], texts[::3])
    (toxic_a, toxic_b), (ordinary_a, ordinary_b) = rest(toxic), rest(ordinary)
    made, base = train_dictionaries(toxic_a, ordinary_a)
    labels = np.array([1.0] * len(toxic_b) + [0.0] * len(ordinary_b))
    best = (np.inf, ToxicModel(made[0], base, np.zeros(7), np.ones(7), np.array([-2.0] + [0.0] * 7)))
    for content in made if len(labels) else ():
        figures = text_figures(toxic_b + ordinary_b, content, base)
        model = ToxicModel(content, base, *calibrate(figures, labels))
        scores = np.clip(model.scores(figures), 1e-9, 1 - 1e-9)
        loss = -np.mean(labels * np.log(scores) + (1 - labels) * np.log(1 - scores))
        if loss < best[0]:
            best = (loss, model)
    return best[1]


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Rows never trained on: crc32 of the id's text leaves no remainder. False for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def train_toxicity(docs: DataFrame, labels: DataFrame, text: str = "text") -> ToxicModel:
    """Model from a bounded sample of the labelled rows outside the held-out fold.

    Of each class the labelled ids whose hashes come first are drawn, a fixed number, and their texts are
    looked up in one scan; up to CLASS_BYTES of them train. Texts beyond TEXT_BYTES are only scored.
    """
    known = labels.where(~held_out(F.col("doc_id")) & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()) \
        .select("doc_id", "toxic").distinct()
    most = {1: TOXIC_ROWS, 0: ORDINARY_ROWS}
    # Half as many again as train, as copies and long texts fall away.
    drawn = [known.where(F.col("toxic") == value).orderBy(F.xxhash64("doc_id"), "doc_id")
             .limit(rows + rows // 2) for value, rows in most.items()]
    drawn = F.broadcast(materialize(drawn[0].union(drawn[1]), "toxic-labels"))  # 4,800 ids at most
    rows = materialize(
        docs.select("doc_id", F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
        .where((F.octet_length("text") > 0) & (F.octet_length("text") <= TEXT_BYTES))
        .join(drawn, "doc_id").select("text", "toxic"), "toxic-sample").distinct()
    taken = []
    for value, count in most.items():
        sample = rows.where(F.col("toxic") == value).orderBy(F.xxhash64("text"), "text").limit(count)
        texts = [r["text"].encode(errors="replace") for r in sample.collect()]
        upto = np.cumsum([len(t) for t in texts])
        taken.append(texts[:int(np.searchsorted(upto, CLASS_BYTES, side="right"))])
    return fit(*taken)


def score_udf(model: ToxicModel):
    @F.arrow_udf(DOUBLE)
    def scores(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            yield pa.array(column_scores(model, column), pa.float64())
    return scores


def column_scores(model: ToxicModel, column: pa.Array) -> np.ndarray:
    """Scores of a column's texts, in parts of about PART_BYTES."""
    run, bounds = text_bytes(column)
    out, part, held = [np.zeros(0)], [], 0
    for a, b in zip(bounds.tolist(), bounds[1:].tolist()):
        if part and held + b - a > PART_BYTES:
            out.append(model.scores(text_figures(part, model.toxic, model.ordinary)))
            part, held = [], 0
        part.append(bytes(run[a:b]))
        held += b - a
    if part:
        out.append(model.scores(text_figures(part, model.toxic, model.ordinary)))
    return np.concatenate(out)


def score_toxicity(docs: DataFrame, model: ToxicModel, text: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text in ``into`` (a column of that name is replaced).

    Null and empty texts have no windows and get the calibration's score for that. Every row comes back.
    """
    return docs.withColumn(into, score_udf(model)(F.col(text)))


def drop_toxic(docs: DataFrame, model: ToxicModel, threshold: float = 0.5, text: str = "text") -> DataFrame:
    """``docs`` without the rows that score at or above the threshold."""
    score = free_name(docs, "score")
    return score_toxicity(docs, model, text, score).where(F.col(score) < threshold).drop(score)


ships_by_value(__name__)
