"""Exact substring dedup by distributed prefix doubling.

Suffixes are ranked by growing prefixes and leave as soon as their rank is unique; those that reach
``LIMIT`` bytes with company are repeats. Two things keep the number of (position, rank) rows small:

- Only sampled positions start: in every stretch of ``LIMIT`` bytes the one whose first ``PREFIX`` bytes
  have the least hash (leftmost). Equal stretches choose equal places, so none is missed, and about
  every 37th position stays. A position stands for the consecutive stretches that chose it, and the
  names of its first ``PREFIX`` bytes are doubled up inside the task, without a shuffle.
- Positions whose whole surroundings (all bytes of their stretches) are the same share one rank from
  there on: the earliest goes on, the others are repeats in full.

Ranks are hash names instead of ordinal numbers, as only equality matters. Sorting by name brings
equal prefixes together: first at ``PREFIX`` bytes, then at ``MIDDLE`` bytes to either side (any stretch
reaches that far to the left or to the right of its position), then at ``LIMIT`` bytes, where the bytes
themselves are compared. Positions with the same surroundings are not: there two 64-bit names, of the first
``PREFIX`` bytes and of all surroundings, are taken for the bytes, 128 bits in all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.common import BYTES, LONG, rows_of, ships_by_value, struct_of, text_bytes
from plumbline.session import materialize

LIMIT, PREFIX = 100, 32
_CHOICES = LIMIT - PREFIX + 1
# Bytes beyond the prefix that some stretch of a position reaches on one side at least.
MIDDLE = (LIMIT - PREFIX) // 2
# Long texts are ranked in slices of so many positions.
SLICE = 1 << 20
# Prefixes with more rows than this are hot: found in every 64th text, and spread over SPREAD tasks.
HOT_ROWS, HOT_SHARE, SPREAD = 100_000, 64, 64
# Hot prefixes (at most one in HOT_ROWS rows) that may be broadcast.
HOT_BROADCAST = 1_000_000
# Groups of surroundings up to this many are compared in one task, larger ones by rows of stretches.
GROUP = 4096

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xC2B2AE3D27D4EB4F)
_LETTERS = np.random.default_rng(100).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def prefix_names(codes: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit name for the ``length`` bytes from each position, by doubling."""
    names, reach = _LETTERS[codes], 1
    while reach < length:
        step = min(reach, length - reach)
        names = names[:-step] * _ODD + names[step:]
        names ^= names >> np.uint64(29)
        names *= _MIX
        names ^= names >> np.uint64(32)
        reach += step
    return names


def _least(values: np.ndarray, width: int) -> np.ndarray:
    reach = 1
    while reach < width:
        step = min(reach, width - reach)
        values = np.minimum(values[:-step], values[step:])
        reach += step
    return values


def sampled_positions(codes: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of a text of at least LIMIT bytes: position, first and last stretch that chose it, name."""
    names = prefix_names(codes, PREFIX)
    order = (names * _MIX) ^ (names >> np.uint64(31))
    least = _least(order, _CHOICES)
    heads = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
    tails = np.append(heads[1:], len(least)) - 1
    choose = lambda at: at + order[at[:, None] + np.arange(_CHOICES)].argmin(axis=1)
    chosen = choose(heads)
    tied = np.flatnonzero(tails > chosen)  # the same bytes again within reach
    if len(tied):
        count = tails[tied] - chosen[tied]
        starts = np.concatenate(([0], np.cumsum(count)[:-1]))
        rest = np.repeat(chosen[tied] + 1 - starts, count) + np.arange(int(count.sum()))
        places = np.concatenate([choose(rest[i:i + 20_000]) for i in range(0, len(rest), 20_000)])
        new = np.flatnonzero(np.concatenate(([True], (np.diff(places) != 0) | (np.diff(rest) != 1))))
        tails[tied] = chosen[tied]
        heads = np.concatenate((heads, rest[new]))
        tails = np.concatenate((tails, rest[np.append(new[1:], len(rest)) - 1]))
        chosen = np.concatenate((chosen, places[new]))
    return chosen, heads, tails, names[chosen]


# first stretch, position and last stretch in one number that sorts by the first stretch
def pack(first, position, last):
    return first << 14 | (position - first) << 7 | (last - first)


def unpack(at):
    first = at >> 14
    return first, first + (at >> 7 & 127), first + (at & 127)


_RANKED = rows_of(code=LONG, around=LONG, at=LONG)


@F.arrow_udf(_RANKED)
def ranked_positions(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Per text its sampled positions: name, hash of their surroundings, packed place."""
    for column in texts:
        yield column_positions(column)


def column_positions(column: pa.Array) -> pa.Array:
    run, bounds = text_bytes(column)
    counts, code, around, places = [0], [], [], []
    for a, b in zip(bounds.tolist(), bounds[1:].tolist()):
        n = 0
        for at in range(a, b - LIMIT + 1, SLICE):
            end = min(b, at + SLICE + LIMIT - 1)
            position, first, last, name = sampled_positions(np.frombuffer(run, np.uint8, end - at, at))
            hashes = (xxhash.xxh64_intdigest(run[x:y], z) for x, y, z in zip(
                (at + first).tolist(), (at + last + LIMIT).tolist(), (position - first).tolist()))
            around.append(np.fromiter(hashes, np.uint64, len(first)))
            code.append(name)
            places.append(pack(first + (at - a), position + (at - a), last + (at - a)))
            n += len(first)
        counts.append(n)
    whole = lambda parts, kind: np.concatenate(parts or [np.zeros(0, kind)]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(np.cumsum(counts), pa.int32()), pa.StructArray.from_arrays(
        [pa.array(whole(code, np.uint64)), pa.array(whole(around, np.uint64)),
         pa.array(whole(places, np.int64))], ["code", "around", "at"]))


@F.arrow_udf(BYTES)
def packed(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Texts compressed for a shuffle."""
    press = zstandard.ZstdCompressor(level=1)
    for column in texts:
        run, bounds = text_bytes(column)
        yield pa.array([press.compress(run[a:b]) for a, b in zip(bounds, bounds[1:])], pa.binary())


def unpacked(column: pa.Array) -> Iterator[bytes]:
    unpress = zstandard.ZstdDecompressor()
    for item in column:
        yield unpress.decompress(item.as_py())


_STRETCHES = rows_of(high=LONG, low=LONG, begin=LONG, content=BYTES)


@F.arrow_udf(_STRETCHES)
def surroundings(texts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """For each given place the stretches that reach MIDDLE bytes to its left, and the others, which
    reach as far to its right: name of those bytes, first stretch, and the bytes of the stretches."""
    kind = pa.struct([("high", pa.int64()), ("low", pa.int64()), ("begin", pa.int64()),
                      ("content", pa.binary())])
    for column, places in texts:
        out = []
        for text, ats in zip(unpacked(column), places.to_pylist()):
            rows = []
            for at in ats:
                first, position, last = unpack(at)
                for side, lo, hi, name in (
                        (0, first, min(last, position - MIDDLE), (position - MIDDLE, position + PREFIX)),
                        (1, max(first, position - MIDDLE + 1), last, (position, position + PREFIX + MIDDLE))):
                    if lo <= hi:
                        digest = xxhash.xxh3_128_digest(text[name[0]:name[1]], side)
                        high, low = np.frombuffer(digest, ">i8").tolist()
                        rows.append({"high": high, "low": low, "begin": lo, "content": text[lo:hi + LIMIT]})
            out.append(rows)
        yield pa.array(out, pa.list_(kind))


def repeated_stretches(group: list[dict]) -> list[tuple[int, int, int]]:
    """(index in the group, begin, end) of the bytes of stretches seen earlier in doc and begin order."""
    seen: dict[bytes, tuple[int, int]] = {}
    found = []
    for i in range(len(group)):
        content, begin = group[i]["content"], group[i]["begin"]
        run = None
        for k in range(len(content) - LIMIT + 1):
            mine = (group[i]["doc_nr"], begin + k)
            if seen.setdefault(content[k:k + LIMIT], mine) != mine:
                if run and run[2] >= begin + k:
                    run[2] = begin + k + LIMIT
                else:
                    run = [i, begin + k, begin + k + LIMIT]
                    found.append(run)
    return [tuple(r) for r in found]


_RUNS = rows_of(nr=T.IntegerType(), begin=LONG, end=LONG)


@F.arrow_udf(_RUNS)
def compared(groups: Iterator[pa.Array]) -> Iterator[pa.Array]:
    kind = pa.struct([("nr", pa.int32()), ("begin", pa.int64()), ("end", pa.int64())])
    for column in groups:
        out = []
        for group in column.to_pylist():
            doc_nr = -1
            before = None
            for row in group:  # sorted by document
                if row["doc"] != before or doc_nr < 0:
                    doc_nr, before = doc_nr + 1, row["doc"]
                row["doc_nr"] = doc_nr
            out.append([{"nr": i, "begin": a, "end": b} for i, a, b in repeated_stretches(group)])
        yield pa.array(out, pa.list_(kind))


def find_repeats(docs: DataFrame, doc: Column, text: str = "text", hot_rows: int = HOT_ROWS,
                 group: int = GROUP) -> DataFrame:
    """(doc, begin, end): bytes covered by a stretch of LIMIT bytes that also starts earlier.

    ``doc`` is a struct that identifies and orders the documents. The same byte may come back often.
    """
    long_enough = docs.where(F.octet_length(text) >= LIMIT).select(doc.alias("doc"), F.col(text).alias("text"))
    ranked = long_enough.select("doc", F.inline(ranked_positions("text")))

    # Rank at PREFIX bytes. A hot prefix is no unique one: its rows pass, wherever they are counted.
    sample = long_enough.where(F.pmod(F.xxhash64("doc"), F.lit(HOT_SHARE)) == 0) \
        .select(F.inline(ranked_positions("text")))
    hot = materialize(sample.groupBy("code").agg(F.count(F.lit(1)).alias("n"))
                      .where(F.col("n") > hot_rows // HOT_SHARE).select("code"), "suffix-hot")
    n_hot = hot.count()
    hot = hot.withColumn("hot", F.lit(True))
    marked = ranked.join(F.broadcast(hot) if n_hot <= HOT_BROADCAST else hot, "code", "left") if n_hot \
        else ranked.withColumn("hot", F.lit(None).cast("boolean"))
    spread = F.when(F.col("hot"), F.pmod(F.xxhash64("doc", "at"), F.lit(SPREAD))).otherwise(F.lit(0))
    shared = F.count(F.lit(1)).over(Window.partitionBy("code", "spread"))
    repeated = materialize(
        marked.withColumn("spread", spread).withColumn("n", shared)
        .where((F.col("n") > 1) | F.col("hot")).drop("n", "hot", "spread"), "suffix-repeated")

    # Equal surroundings: the earliest stands for all, the others are repeats from end to end.
    stands = repeated.groupBy("code", "around").agg(F.min(F.struct("doc", "at")).alias("first"))
    several = stands.groupBy("code").agg(F.count(F.lit(1)).alias("kinds"))
    stands = materialize(stands.join(several, "code"), "suffix-stands")
    copies = repeated.join(stands.select("code", "around", "first"), ["code", "around"]) \
        .where(F.struct("doc", "at") != F.col("first")) \
        .select("doc", *_bounds(F.col("at")))

    # Rank at MIDDLE bytes to the left or right, of the earliest only where surroundings differ.
    places = stands.where(F.col("kinds") > 1).select("first.doc", "first.at") \
        .groupBy("doc").agg(F.collect_list("at").alias("places"))  # at most one per byte of the text
    texts = long_enough.select("doc", packed("text").alias("text"))
    pieces = texts.join(places, "doc").select("doc", F.inline(surroundings("text", "places")))
    several = F.count(F.lit(1)).over(Window.partitionBy("high", "low"))
    pieces = materialize(pieces.withColumn("n", several).where(F.col("n") > 1), "suffix-pieces")

    # Rank at LIMIT bytes: the bytes themselves.
    small = pieces.where(F.col("n") <= group).groupBy("high", "low").agg(
        F.sort_array(F.collect_list(F.struct("doc", "begin", "content"))).alias("group"))
    runs = small.select("group", F.inline(compared("group"))) \
        .select(F.get("group", F.col("nr"))["doc"].alias("doc"), "begin", "end")
    large = pieces.where(F.col("n") > group)
    if not large.isEmpty():
        rows = large.select("doc", F.explode(F.sequence(
            F.lit(0), F.octet_length("content") - LIMIT)).alias("k"), "begin", "content") \
            .select("doc", (F.col("begin") + F.col("k")).alias("begin"),
                    F.substring("content", F.col("k") + 1, LIMIT).alias("stretch"))
        first = rows.groupBy("stretch").agg(F.min(F.struct("doc", "begin")).alias("first"))
        runs = runs.unionByName(
            rows.join(first, "stretch").where(F.struct("doc", "begin") != F.col("first"))
            .select("doc", "begin", (F.col("begin") + LIMIT).alias("end")))
    return copies.unionByName(runs)


def _bounds(at: Column) -> tuple[Column, Column]:
    first = F.shiftright(at, 14)
    return first.alias("begin"), (first + at.bitwiseAND(F.lit(127)) + LIMIT).alias("end")


_CUT = struct_of(kept=BYTES, spans=rows_of(begin=LONG, end=LONG))


@F.arrow_udf(_CUT)
def cut(texts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """The bytes left of each packed text, and the maximal runs removed."""
    span = pa.struct([("begin", pa.int64()), ("end", pa.int64())])
    for column, removed in texts:
        kept, spans = [], []
        for text, runs in zip(unpacked(column), removed.to_pylist()):
            merged: list[list[int]] = []
            for r in sorted((r["begin"], r["end"]) for r in runs or ()):
                if merged and r[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], r[1])
                else:
                    merged.append(list(r))
            ends = [0, *[b for _, b in merged]]
            starts = [*[a for a, _ in merged], len(text)]
            kept.append(b"".join(text[a:b] for a, b in zip(ends, starts)))
            spans.append([{"begin": a, "end": b} for a, b in merged])
        yield pa.StructArray.from_arrays(
            [pa.array(kept, pa.binary()), pa.array(spans, pa.list_(span))], ["kept", "spans"])


def drop_repeats(docs: DataFrame, text: str = "text", hot_rows: int = HOT_ROWS, group: int = GROUP) -> DataFrame:
    """doc_id, ``kept`` (the bytes left, which may end inside a character) and ``spans`` (maximal runs of
    removed bytes) for every row of ``docs``.

    Every byte covered by a string of LIMIT bytes that also starts earlier goes: in a smaller doc_id, or
    further to the front. A null doc_id is the smallest. Null texts are empty; texts of fewer than LIMIT
    bytes keep all. Rows with one doc_id and different texts are told apart by their texts' hash; rows
    that agree in both are one document and come back as often as given. Other columns are ignored.
    """
    repeats = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    names = ["doc_id"] if repeats.isEmpty() else ["doc_id", "text_key"]
    keyed = docs.select("doc_id", F.xxhash64(F.col(text).cast("string")).alias("text_key"),
                        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    doc = F.struct(*names)
    removed = find_repeats(keyed, doc, "text", hot_rows, group) \
        .groupBy("doc").agg(F.collect_set(F.struct("begin", "end")).alias("runs"))  # within one text
    texts = keyed.select("doc_id", doc.alias("doc"), packed("text").alias("text"))
    return texts.join(removed, "doc", "left").select("doc_id", cut("text", "runs").alias("cut")) \
        .select("doc_id", "cut.kept", "cut.spans")


ships_by_value(__name__)
