"""SimHash near-duplicates by pivot distance tables.

A fingerprint's table holds its Hamming distances to many reference fingerprints, block by block.
Distances of two fingerprints to one reference differ by no more than the fingerprints do, so

- fingerprints at most ``MOST_BITS`` apart differ in at most ``MOST_BITS`` of the ``BLOCKS`` blocks and
  have equal distances to all references in the others: their table entries of some set of
  ``BLOCKS - MOST_BITS`` blocks are the same, which makes an equi-join key;
- inside a bucket of that join, pairs whose distances differ by more than ``MOST_BITS`` at some
  reference are discarded, and only the survivors are compared bit by bit.

A bucket gives a spanning forest of its links, never all pairs. A bucket too large to compare is
joined through the points between its fingerprints instead, which is exact as well. Components of the
links come from alternating star contractions.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import LONG, free_name, ships_by_value, text_bytes
from plumbline.session import materialize

SHINGLE, SEED, BITS = 3, 42, 64
MOST_BITS = 3
# Bits of each block, from the lowest.
BLOCKS = (11, 11, 11, 11, 10, 10)
REFERENCES = 8
# Buckets up to this many fingerprints are compared inside one task.
BUCKET = 256
_LOW_BITS = 0x0101010101010101


def fingerprint_of(words: list[bytes]) -> int:
    """Signed 64-bit SimHash of a word sequence; 0 without words."""
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*[words[i:] for i in range(SHINGLE)]))
    return majority(np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64))


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half of the hashes, as a signed number."""
    # Eight byte-wide counters per lane, emptied before any can pass 255.
    lanes = (hashes[:, None] >> np.arange(8, dtype=np.uint64)) & np.uint64(_LOW_BITS)
    counts = np.add.reduceat(lanes, np.arange(0, len(hashes), 255), axis=0)
    ones = counts.view(np.uint8).reshape(-1, 8, 8).sum(axis=0, dtype=np.int64)  # [shift, byte]
    most = 2 * ones > len(hashes)
    value = sum(int(most[bit, byte]) << (8 * byte + bit) for byte in range(8) for bit in range(8))
    return value - (1 << BITS) if value >> (BITS - 1) else value


@F.arrow_udf(LONG)
def simhash(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Fingerprint of each whole text: A-Z lower-cased, words split at ASCII white space."""
    for column in texts:
        yield pa.array(fingerprints_of(column), pa.int64())


def fingerprints_of(column: pa.Array) -> list[int]:
    run, bounds = text_bytes(column)
    return [fingerprint_of(bytes(run[a:b]).lower().split()) for a, b in zip(bounds, bounds[1:])]


def hex_fingerprint(fingerprint: Column) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


def references() -> list[int]:
    """Seeded 64-bit patterns."""
    return [xxhash.xxh64_intdigest(f"reference {i}", SEED) for i in range(REFERENCES)]


def block_masks() -> list[int]:
    starts = np.cumsum((0,) + BLOCKS)
    return [((1 << width) - 1) << int(start) for width, start in zip(BLOCKS, starts)]


def signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def pivot_tables(fingerprint: Column) -> list[Column]:
    """Per block, the distances to all references inside it, four bits each."""
    tables = []
    for mask in block_masks():
        entry = F.lit(0).cast("long")
        for i, reference in enumerate(references()):
            apart = F.bit_count(fingerprint.bitwiseXOR(F.lit(signed(reference)))
                                .bitwiseAND(F.lit(signed(mask))))
            entry = entry.bitwiseOR(F.shiftleft(apart.cast("long"), 4 * i))
        tables.append(entry)
    return tables


def link_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spanning links (a, b) of buckets given as lists of distinct fingerprints."""
    masks = np.array(block_masks(), np.uint64)
    pivots = np.array(references(), np.uint64)
    for batch in batches:
        found_a, found_b = [], []
        lists = batch.column(0)
        starts = lists.offsets.to_numpy()
        values, sizes = lists.values.to_numpy(zero_copy_only=False), np.diff(starts)
        for size in np.unique(sizes):
            groups = values[starts[:-1][sizes == size][:, None] + np.arange(size)]
            room = max(1, (1 << 20) // int(size * size))
            for begin in range(0, len(groups), room):
                members = np.sort(groups[begin:begin + room], axis=1)
                bits = members.view(np.uint64)
                tables = np.bitwise_count((bits[..., None, None] ^ pivots) & masks[:, None]) \
                    .astype(np.int8).sum(axis=2, dtype=np.int8)
                bucket, i, j = np.nonzero(np.triu(np.ones((size, size), bool), 1)[None]
                                          .repeat(len(members), axis=0))
                gap = np.zeros(len(i), np.int8)
                for k in range(REFERENCES):
                    np.maximum(gap, np.abs(tables[bucket, i, k] - tables[bucket, j, k]), out=gap)
                near = gap <= MOST_BITS
                bucket, i, j = bucket[near], i[near], j[near]
                near = np.bitwise_count(bits[bucket, i] ^ bits[bucket, j]) <= MOST_BITS
                bucket, i, j = bucket[near], i[near], j[near]
                # Least position reachable, by repeated minimum over the links.
                low = np.tile(np.arange(size), (len(members), 1))
                while len(i):
                    before = low.copy()
                    np.minimum.at(low, (bucket, j), low[bucket, i])
                    np.minimum.at(low, (bucket, i), low[bucket, j])
                    if np.array_equal(before, low):
                        break
                b, at = np.nonzero(low < np.arange(size))
                found_a.append(members[b, low[b, at]])
                found_b.append(members[b, at])
        if found_a:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(found_a)), pa.array(np.concatenate(found_b))], ["a", "b"])


def steps_between(spark, masks: list[int]) -> DataFrame:
    """(blocks, far, flip): all ways to flip up to two bits outside each mask; a table of fixed size."""
    rows = []
    for n, mask in enumerate(masks):
        free = [1 << bit for bit in range(BITS) if not mask >> bit & 1]
        rows += [(n, far, signed(sum(bits))) for far in range(3) for bits in combinations(free, far)]
    return spark.createDataFrame(rows, "blocks int, far int, flip long")


def near_links(fingerprints: DataFrame) -> DataFrame:
    """Links (a, b) with the components of all pairs of distinct ``fp`` at most ``MOST_BITS`` apart."""
    tables = pivot_tables(F.col("fp"))
    kept = list(combinations(range(len(BLOCKS)), len(BLOCKS) - MOST_BITS))
    masks = [sum(block_masks()[b] for b in blocks) for blocks in kept]
    keyed = materialize(fingerprints.select("fp", *[t.alias(f"d{i}") for i, t in enumerate(tables)])
                        .select("fp", F.posexplode(F.array(*[
                            F.xxhash64(F.lit(n), *[F.col(f"d{b}") for b in blocks])
                            for n, blocks in enumerate(kept)])).alias("blocks", "key")), "simhash-keys")
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    buckets = materialize(keyed.join(shared, "key"), "simhash-buckets")
    small = buckets.where(F.col("n") <= BUCKET).groupBy("key") \
        .agg(F.collect_list("fp").alias("members")).select("members") \
        .mapInArrow(link_buckets, "a long, b long")

    large = buckets.where(F.col("n") > BUCKET)
    if large.isEmpty():
        return small.distinct()
    # Fingerprints at most 3 apart meet at a point at most 1 from the one and 2 from the other. All that
    # meet at a point near which (1 bit) some fingerprint lies are within 3 of that one.
    met = large.join(F.broadcast(steps_between(large.sparkSession, masks)), "blocks") \
        .withColumn("point", F.col("fp").bitwiseXOR(F.col("flip"))) \
        .groupBy("blocks", "point").agg(
            F.min(F.when(F.col("far") <= 1, F.col("fp"))).alias("a"),
            F.collect_set("fp").alias("around"))  # at most all points within two bits
    through = met.where(F.col("a").isNotNull() & (F.size("around") > 1)) \
        .select("a", F.explode("around").alias("b")).where(F.col("a") != F.col("b"))
    return small.union(through).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def star_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b), root the least node of its component.

    Large-star and small-star rounds; each is written to shared storage, so a lost executor costs one
    round at most. Roots and leaves of any degree are met by aggregation and joins alone.
    """
    edges = materialize(links.select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")

    def sign(df):
        return df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()

    before = sign(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(least, "u") \
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialize(large, "links")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .where(F.col("u") != F.col("v")).union(least.select("u", F.col("m").alias("v"))).distinct()
        edges = materialize(small, "links")
        after = sign(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def fingerprint_classes(hashed: DataFrame, fingerprint: str = "fp", ident: str = "doc_id") -> DataFrame:
    """(fp, root, component_id) for each distinct fingerprint: root is the component's least fingerprint,
    component_id the smallest ident reachable."""
    distinct = materialize(hashed.groupBy(F.col(fingerprint).alias("fp")).agg(
        F.min(ident).alias("least")), "fingerprints")
    roots = star_components(near_links(distinct))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left") \
        .withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(least, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id for every row of ``docs``.

    Null and empty texts have fingerprint zero, which links like any other. Repeated rows come back as
    often as they were given. A component of null ids only has a null component_id. Other columns are
    ignored, so their names never clash. An empty table gives an empty result.
    """
    hashed = materialize(docs.select("doc_id", simhash(F.col(text)).alias("fp")), "simhash")
    classes = materialize(fingerprint_classes(hashed), "simhash-classes")
    return hashed.join(classes, "fp").select(
        "doc_id", hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row of each component of near-duplicates, with the columns of ``docs``.

    The row with the smallest doc_id stays; of repeated rows one, and a null doc_id comes last.
    """
    hashed = simhash(F.col(text))
    slim = materialize(docs.select("doc_id", hashed.alias("fp")), "simhash")
    classes = materialize(fingerprint_classes(slim), "simhash-classes")
    return one_of_each(docs, hashed, slim, classes)


def one_of_each(docs: DataFrame, key: Column, slim: DataFrame, classes: DataFrame) -> DataFrame:
    """One row of ``docs`` of each root, the one with the smallest doc_id.

    ``key`` gives each row's fp, ``slim`` has doc_id and fp of all rows, ``classes`` fp and root.
    """
    fp, rep_fp, rep_id, copies, place = (
        free_name(docs, n) for n in ("fp", "kept_fp", "kept_id", "copies", "place"))
    hashed = docs.withColumn(fp, key)
    # One (doc_id, fp) stands for each component.
    stands = materialize(
        slim.groupBy("doc_id", "fp").agg(F.count(F.lit(1)).alias("n")).join(classes, "fp")
        .groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "fp", "n")).alias("s"))
        .select(F.col("s.doc_id").alias(rep_id), F.col("s.fp").alias(rep_fp), F.col("s.n").alias(copies)),
        "simhash-kept")
    same = (F.col(fp) == F.col(rep_fp)) & F.col("doc_id").eqNullSafe(F.col(rep_id))
    kept = hashed.join(stands.where(F.col(copies) == 1), same).select(docs.columns)
    repeated = stands.where(F.col(copies) > 1)
    if repeated.isEmpty():
        return kept
    flat = [c for c, kind in docs.dtypes if not kind.startswith(("map", "variant", "array<map"))]
    first = Window.partitionBy(fp, "doc_id").orderBy(F.xxhash64(*flat))
    return kept.union(hashed.join(repeated, same).withColumn(place, F.row_number().over(first))
                      .where(F.col(place) == 1).select(docs.columns))


ships_by_value(__name__)
