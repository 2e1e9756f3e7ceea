"""Near copies: SimHash fingerprints linked by pivot tables, held to a Jaccard index of ``LIKE``.

A text is the set of its ``SHINGLE``-word shingles, as 64-bit hashes; its fingerprint is the SimHash of that
set. The pivot tables of `simhash` link near fingerprints, and the sets of these links are compared shingle by
shingle. Sets at the index differ in about ten bits, too many for fingerprints alone, so what the links leave
apart goes through an exact join of the sets. Every pair of texts that reaches the index is found, because
each filter of it passes all of them:

- prefix filter: with the shingles of all sets in one common order, two sets that reach p/q share one
  among the first n - ceil(p n / q) + 1 of each, which makes an equi-join key. Any order will do;
  shingles that are frequent in a sample of the texts come last, so keys are seldom shared by chance;
- length filter: the smaller set has at least p/q of the larger one's shingles;
- parity filter: a set's parity map has a bit for each residue of its shingles, set if an odd number
  falls there. Maps differ in no more bits than the sets differ in shingles.

Pairs that pass are compared shingle by shingle. As only the components of the links matter, each text
of a bucket first proposes two of its pairs with texts the fingerprints have not joined it to; what the links
found so far do not join is then compared in full.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.common import BYTES, LONG, ships_by_value, struct_of, text_bytes
from plumbline.llm.simhash import majority, near_links, one_of_each, star_components
from plumbline.session import BROADCAST_BYTES, materialize, small_batches

SHINGLE, SEED = 5, 42
# Least Jaccard index, p / q.
LIKE = (4, 5)
# Texts sampled for frequent shingles, in how many of them one is frequent, and how many are listed.
# They decide about the order of shingles, not about the result.
SAMPLE, OFTEN, LISTED = 20_000, 4, 50_000
# Sets compared in one task; a larger bucket is compared in pairs of parts of half that size.
BUCKET = 8192
# Words of parity maps compared in one step.
STEP_WORDS = 1 << 21
# Links of one set that may meet its shingles in one task.
HUB = 1000


def shingles_of(text: bytes) -> np.ndarray:
    """Sorted distinct hashes; of a text with fewer words than a shingle, the hash of all its words."""
    words = text.lower().split()
    if len(words) < SHINGLE:
        runs = [b" ".join(words)] * bool(words)
    else:
        runs = map(b" ".join, zip(*[words[i:] for i in range(SHINGLE)]))
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, runs, repeat(SEED)), np.uint64))


def prefix_length(n: int) -> int:
    p, q = LIKE
    return n + (-p * n) // q + 1 if n else 0


def parity_map(shingles: np.ndarray) -> bytes:
    """As many bits as shingles, up to the next power of two, at least 64."""
    width = max(64, 1 << (len(shingles) - 1).bit_length()) if len(shingles) else 64
    counts = np.bincount((shingles & np.uint64(width - 1)).astype(np.int64), minlength=width)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def _texts(column: pa.Array) -> Iterator[bytes]:
    run, bounds = text_bytes(column)
    return (bytes(run[a:b]) for a, b in zip(bounds, bounds[1:]))


def _arrays(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0] + [len(p) for p in parts])
    values = np.concatenate(parts).view(np.int64) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int64()))


@F.arrow_udf(T.ArrayType(LONG))
def shingle_list(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for column in texts:
        yield _arrays([shingles_of(t) for t in _texts(column)])


def shingle_sets(text: Column, frequent: np.ndarray, counts: np.ndarray) -> Column:
    """id (hash of the set, 0 for the empty one), n, fingerprint, prefix and parity map of each text."""
    @F.arrow_udf(struct_of(id=LONG, n=LONG, print=LONG, prefix=T.ArrayType(LONG), parity=BYTES))
    def sets(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            ids, sizes, prints, prefixes, maps = [], [], [], [], []
            for one in _texts(column):
                found = shingles_of(one)
                ids.append(xxhash.xxh64_intdigest(found.tobytes(), SEED) if len(found) else 0)
                sizes.append(len(found))
                prints.append(majority(found) if len(found) else 0)
                weight = np.zeros(len(found), np.int64)
                if len(frequent):
                    at = np.minimum(np.searchsorted(frequent, found), len(frequent) - 1)
                    weight = np.where(frequent[at] == found, counts[at], 0)
                # The hashes are sorted, so a stable sort orders by (weight, hash).
                prefixes.append(found[np.argsort(weight, kind="stable")[:prefix_length(len(found))]])
                maps.append(parity_map(found))
            yield pa.StructArray.from_arrays(
                [pa.array(np.array(ids, np.uint64).view(np.int64)), pa.array(sizes, pa.int64()),
                 pa.array(prints, pa.int64()), _arrays(prefixes), pa.array(maps, pa.binary())],
                ["id", "n", "print", "prefix", "parity"])

    return sets(text)


def frequent_shingles(docs: DataFrame, text: str) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles of a sample of the texts, sorted, and in how many of them they are."""
    total = docs.count()
    sample = docs.select(text) if total <= SAMPLE else docs.select(text).sample(SAMPLE / total, SEED)
    rows = sample.distinct().select(F.explode(shingle_list(F.col(text))).alias("s")).groupBy("s") \
        .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= OFTEN) \
        .orderBy(F.desc("n"), "s").limit(LISTED).toArrow()  # at most LISTED rows
    listed = rows.column("s").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(listed)
    return listed[order], rows.column("n").to_numpy().astype(np.int64)[order]


def _close(maps: np.ndarray, sizes: np.ndarray, other: np.ndarray, other_sizes: np.ndarray):
    """(i, j, distance) of all pairs that pass the length and the parity filter."""
    p, q = LIKE
    step = max(1, STEP_WORDS // max(1, other.size))
    for begin in range(0, len(maps), step):
        n = sizes[begin:begin + step, None]
        apart = np.bitwise_count(maps[begin:begin + step, None] ^ other[None]).sum(axis=2, dtype=np.int64)
        ok = (apart * (p + q) <= (q - p) * (n + other_sizes)) \
            & (q * np.minimum(n, other_sizes) >= p * np.maximum(n, other_sizes))
        i, j = np.nonzero(ok)
        yield i + begin, j, apart[i, j] / (sizes[i + begin] + other_sizes[j])


def bucket_pairs(ids: np.ndarray, roots: np.ndarray, sizes: np.ndarray, maps: list[bytes], full: bool):
    """Pairs (a, b) of a bucket that pass the filters and have different roots.

    All of them, or for each set the pair nearest by parity and the one with the least id.
    """
    width = np.array([len(m) for m in maps])
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    for w in np.unique(width):
        mine, twice = np.flatnonzero(width == w), np.flatnonzero(width == 2 * w)
        own = np.frombuffer(b"".join(maps[k] for k in mine), np.uint64).reshape(len(mine), -1)
        # Sets that pass the length filter have maps of equal width or one twice as wide, folded here.
        wide = np.frombuffer(b"".join(maps[k] for k in twice), np.uint64).reshape(len(twice), 2, -1) \
            if len(twice) else np.zeros((0, 2, own.shape[1]), np.uint64)
        others = np.concatenate((mine, twice))
        every = np.concatenate((own, wide[:, 0] ^ wide[:, 1]))
        for i, j, apart in _close(own, sizes[mine], every, sizes[others]):
            a, b = mine[i], others[j]
            new = (roots[a] != roots[b]) & ((width[b] != w) | (a < b))
            found.append((a[new], b[new], apart[new]))
    a, b, apart = (np.concatenate(x) for x in zip(*found))
    if not full and len(a):
        one, other, apart = np.concatenate((a, b)), np.concatenate((b, a)), np.concatenate((apart, apart))
        near = np.lexsort((ids[other], apart, one))
        least = np.lexsort((ids[other], one))
        kept = np.concatenate([o[np.unique(one[o], return_index=True)[1]] for o in (near, least)])
        a, b = one[kept], other[kept]
    return np.minimum(ids[a], ids[b]), np.maximum(ids[a], ids[b])


def proposed(buckets: DataFrame, full: bool) -> DataFrame:
    """Distinct pairs (a, b) of ``buckets`` (key, size, id, root, n, parity)."""
    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            starts, rows = lists.offsets.to_numpy(), lists.values
            ids, roots, sizes = (rows.field(k).to_numpy(zero_copy_only=False) for k in range(3))
            maps = rows.field(3)
            for begin, end in zip(starts, starts[1:]):
                a, b = bucket_pairs(ids[begin:end], roots[begin:end], sizes[begin:end],
                                    maps[begin:end].to_pylist(), full)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    parts = F.when(F.col("size") <= BUCKET, 1).otherwise(F.ceil(F.col("size") * 2 / BUCKET)).cast("int")
    own = F.pmod(F.xxhash64("id"), "parts").cast("int")
    return buckets.withColumn("parts", parts).withColumn("own", own) \
        .withColumn("met", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))) \
        .groupBy("key", F.least("own", "met").alias("one"), F.greatest("own", "met").alias("other")) \
        .agg(F.collect_list(F.struct("id", "root", "n", "parity")).alias("members")) \
        .where(F.size("members") > 1).select("members").mapInArrow(pairs, "a long, b long").distinct()


def alike(one: Column, other: Column) -> Column:
    """Whether two sets reach the index, compared shingle by shingle, row by row in Spark: batches for
    Python would hold thousands of long sets at once."""
    p, q = LIKE
    return F.size(F.array_intersect(one, other)) * (p + q) >= (F.size(one) + F.size(other)) * p


def verified(pairs: DataFrame, sets: DataFrame, texts: DataFrame) -> DataFrame:
    """The ``pairs`` (a, b) of ids in ``sets`` (id, fp) that reach the index; ``texts`` has fp and text."""
    pairs = materialize(pairs, "overlap-pairs")
    used = materialize(
        pairs.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id")
        .agg(F.count(F.lit(1)).alias("links")).join(sets.select("id", "fp"), "id"), "overlap-used")
    small = used.count() * 64 <= BROADCAST_BYTES  # about 64 bytes a row
    sets = materialize(
        texts.join(F.broadcast(used) if small else used, "fp")
        .groupBy("id", "links").agg(F.min("text").alias("text")).select(
            "id", shingle_list(F.col("text")).alias("s"),
            F.call_function("div", F.col("links"), F.lit(HUB)).cast("int").alias("more")), "overlap-sets")
    # Sets of many pairs are copied, and their pairs dealt over the copies.
    hubs = materialize(sets.where(F.col("more") > 0).select("id", "more"), "overlap-hubs")
    if hubs.count() * 64 <= BROADCAST_BYTES:  # about 64 bytes a row
        hubs = F.broadcast(hubs)
    copied = sets.select("id", "s", F.explode(F.sequence(F.lit(0), F.col("more"))).alias("copy"))
    met = pairs
    for side, across in (("a", "b"), ("b", "a")):
        met = met.join(hubs.select(F.col("id").alias(side), F.col("more").alias("m")), side, "left") \
            .withColumn(f"copy_{side}", F.pmod(F.xxhash64(across), F.coalesce("m", F.lit(0)) + 1).cast("int")) \
            .drop("m")
    for side in ("a", "b"):
        met = met.join(copied.select(F.col("id").alias(side), F.col("copy").alias(f"copy_{side}"),
                                     F.col("s").alias(f"s_{side}")), [side, f"copy_{side}"])
    return materialize(met.where(alike(F.col("s_a"), F.col("s_b"))).select("a", "b"), "overlap-links")


def set_buckets(sets: DataFrame) -> DataFrame:
    """(key, size, id): the sets with a prefix shingle in common, each list of sets once."""
    keyed = materialize(sets.select("id", F.explode("prefix").alias("key")), "overlap-keys")
    marks = [F.bit_xor(F.xxhash64(F.lit(k), F.col("id"))).alias(f"mark{k}") for k in (0, 1)]
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size"), *marks).where(F.col("size") > 1) \
        .groupBy("size", "mark0", "mark1").agg(F.min("key").alias("key")).select("key", "size")
    return materialize(keyed.join(shared, "key"), "overlap-buckets")


def print_pairs(sets: DataFrame) -> DataFrame:
    """Pairs (a, b) of sets with one fingerprint, or with fingerprints that the pivot tables link."""
    prints = materialize(sets.where(F.col("n") > 0).groupBy("print").agg(
        F.min("id").alias("least"), F.count(F.lit(1)).alias("sets")), "overlap-prints")
    pairs = near_links(prints.select(F.col("print").alias("fp")))
    for side in ("a", "b"):
        pairs = pairs.join(prints.select(F.col("print").alias(side), F.col("least").alias(f"least_{side}")), side)
    same = sets.join(prints.where(F.col("sets") > 1), "print").where(F.col("id") != F.col("least"))
    return pairs.select(F.least("least_a", "least_b").alias("a"), F.greatest("least_a", "least_b").alias("b")).union(
        same.select("least", "id"))


def set_classes(sets: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, root) for every set that has a link; ``sets`` (id, fp, n, print, prefix, parity) are distinct
    and ``texts`` has fp and text."""
    links = verified(print_pairs(sets), sets, texts)
    buckets = set_buckets(sets)
    shown = sets.select("id", "n", "parity")

    def rooted(links):
        roots = materialize(star_components(links), "overlap-roots")
        return buckets.join(roots.withColumnRenamed("node", "id"), "id", "left") \
            .withColumn("root", F.coalesce("root", "id"))

    links = links.union(verified(
        proposed(rooted(links).join(shown, "id"), False).join(links, ["a", "b"], "left_anti"), sets, texts))
    held = materialize(rooted(links), "overlap-rooted")
    apart = held.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b")) \
        .where(F.col("a") != F.col("b")).select("key")
    rest = verified(proposed(held.join(apart, "key").join(shown, "id"), True)
                    .join(links, ["a", "b"], "left_anti"), sets, texts)
    return star_components(links.union(rest))


def drop_near_copies(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row of each component of texts whose five-word shingles overlap by 0.8 or more.

    The row with the smallest doc_id stays; of repeated rows one, and a null doc_id comes last. Texts
    without words are copies of each other. Columns as in ``docs``.
    """
    with small_batches(docs.sparkSession):
        # Texts are told apart by this key; equal ones have one set.
        key = F.xxhash64(F.col(text).cast("string"))
        made = materialize(docs.select(
            "doc_id", key.alias("fp"), shingle_sets(F.col(text), *frequent_shingles(docs, text)).alias("set")),
            "overlap")
        sets = materialize(made.select("fp", "set.*").groupBy("id").agg(
            F.min("fp").alias("fp"), F.first("n").alias("n"), F.first("print").alias("print"),
            F.first("prefix").alias("prefix"), F.first("parity").alias("parity")), "overlap-distinct")
        texts = docs.select(key.alias("fp"), F.col(text).alias("text"))
        roots = set_classes(sets, texts)
        rows = made.select("doc_id", "fp", F.col("set.id").alias("node"))
        classes = rows.select("fp", "node").distinct().join(roots, "node", "left") \
            .select("fp", F.coalesce("root", "node").alias("root"))
        return one_of_each(docs, key, rows.select("doc_id", "fp"), materialize(classes, "overlap-classes"))


ships_by_value(__name__)
