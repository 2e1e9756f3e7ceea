"""Mixing sources to target weights by Sainte-Lague apportionment.

The words to take are divided into equal blocks. Sources win blocks by the highest quotients
``target / (2 k - 1)``; a source's blocks are apportioned to its shards in the same way, which gives
every shard an integer quota. Inside a shard the quota's blocks are chosen in a seeded order, whole
passes over the shard first. A document's share is what the chosen blocks cover of it.

All per-document work is one shuffle by (source, shard): a source of any size is spread over its
shards. Everything else works on one row per source or per shard.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import SPACED_WORD, text_of
from plumbline.session import materialize

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
BLOCK_WORDS = 1024
BLOCKS_PER_SOURCE = 1000
# A source is spread over one shard for so many rows of the table, and over LEAST_SHARDS at least.
SHARD_ROWS, LEAST_SHARDS = 100_000, 16
# Strides of the seeded order; of any three, one is prime to a number below 10**18.
_STRIDES = (1_000_000_007, 998_244_353, 1_000_000_009)


def _div(product: Column, by: Column) -> Column:
    """Whole quotient of a product that may exceed 64 bits."""
    return F.call_function("div", product, by.cast("decimal(19,0)"))


def _times(a: Column, b: Column) -> Column:
    return a.cast("decimal(19,0)") * b.cast("decimal(19,0)")


def capped_targets(sources: DataFrame, weights: Sequence[int], most: int) -> DataFrame:
    """Add ``weight`` and ``target`` to one row per source (``source``, ``source_size``).

    Sources in code point order, null last, take the weights in turn. A target stops at ``most`` times
    the source's size; the excess is shared among the others by weight until none is above. Sorted by
    how early the cap bites, the capped sources are a prefix, so one running sum settles all rounds.
    """
    order = Window.partitionBy().orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), turn.cast("int") + 1)
    ranked = sources.withColumn("source_no", F.row_number().over(order)).withColumn("weight", weight)
    cap = F.col("source_size") * most
    by_cap = Window.partitionBy().orderBy(
        F.col("bite").asc(), F.col("source_no").asc())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum(cap).over(before), F.lit(0))) \
        .cast("double") / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))) \
        .cast("double")
    sized = ranked.withColumn("bite", cap.cast("double") / F.col("weight").cast("double")) \
        .withColumn("level", level)
    # The lowest level among the rows at or below their cap; none if every source is at its cap.
    settled = F.min(F.when(F.col("level") <= F.col("bite"), F.struct("bite", "source_no", "level"))) \
        .over(whole)["level"]
    raw = F.col("weight") * settled
    return sized.withColumn("target", F.when(
        settled.isNull() | (raw > cap), cap.cast("double")).otherwise(raw)).drop("bite", "level")


def apportion(parties: DataFrame, group: Sequence[str], votes: str, seats: str, ties: str) -> DataFrame:
    """Add ``quota``: each group's ``seats`` given to its rows by the highest Sainte-Lague quotients.

    Quotients far from the last winning one need not be listed: with V votes, S parties and n seats
    the winning divisor lies between V / (n + S / 2) and V / (n - S / 2), which leaves each party a few
    candidate seats (two per party on average). Equal quotients go to the first in order of ``ties``.
    """
    by = Window.partitionBy(*group)
    all_votes, n = F.sum(votes).over(by).cast("double"), F.count(F.lit(1)).over(by)
    wanted, vote = F.col(seats).cast("double"), F.col(votes).cast("double")
    share = F.when(F.col("all_votes") > 0, vote / F.col("all_votes")).otherwise(F.lit(0.0))
    least = F.greatest(F.lit(0), F.floor(share * (wanted - F.col("parties") / 2)) - 1).cast("long")
    most = F.when(vote > 0, F.floor(share * (wanted + F.col("parties") / 2)) + 2) \
        .otherwise(F.lit(0)).cast("long")
    bounded = parties.withColumn("all_votes", all_votes).withColumn("parties", n) \
        .withColumn("least", least).withColumn("most", most)
    candidates = bounded.where(F.col("most") > F.col("least")).withColumn(
        "k", F.explode(F.sequence(F.col("least") + 1, F.col("most")))) \
        .withColumn("quotient", vote / (2 * F.col("k") - 1))
    # Seats below "least" are certain; the others are won in order of their quotients.
    by_quotient = by.orderBy(F.col("quotient").desc(), F.col(ties).asc(), F.col("k").asc())
    won = candidates.withColumn("place", F.row_number().over(by_quotient)) \
        .join(bounded.groupBy(*group).agg(F.sum("least").alias("certain")), list(group)) \
        .where(F.col("place") <= F.col(seats) - F.col("certain")) \
        .groupBy(*group, ties).agg(F.max("k").alias("won"))
    return bounded.join(won, [*group, ties], "left") \
        .withColumn("quota", F.coalesce("won", "least")) \
        .drop("all_votes", "parties", "least", "most", "won")


def mix_sources(
    docs: DataFrame, *, weights: Sequence[int] = WEIGHTS, most: int = MOST_REPEATS, seed: int = 1,
    source: str = "source", size: Column | None = None, n_shards: int | None = None,
) -> DataFrame:
    """``docs`` with ``size`` (words), ``source_size``, ``target`` and ``taken`` (words, repeats counted).

    Every row comes back; ``taken`` is 0 for a row without words or not chosen and at most ``most``
    times its size. Null texts have size 0; a null source is a source of its own, last in order.
    Repeated rows are separate documents; rows without a doc_id, or all where there is no such column, are
    told apart by their other columns. Columns of ``docs`` with the names of result columns are
    replaced. Empty input gives an empty result. The same rows and seed give the same mix, whatever
    the partitioning.
    """
    results = ["size", "source_size", "target", "taken"]
    size = F.regexp_count(text_of(), F.lit(SPACED_WORD)) if size is None else size
    flat = [c for c, kind in docs.dtypes if not kind.startswith(("map", "variant", "array<map"))]
    # Rows without a doc_id are dealt by what else they hold.
    tie = F.xxhash64(*flat)
    ident = F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(*[
        F.col(c).cast("string") for c in ("doc_id",) if c in docs.columns], tie.cast("string"))))
    rows = docs.select(
        F.struct(*[F.col(c) for c in docs.columns if c.lower() not in results]).alias("row"),
        F.col(source).cast("string").alias("source"), size.cast("long").alias("size"),
        ident.alias("ident"), tie.alias("tie"))
    # A key that is never null joins and partitions alike.
    rows = rows.withColumn("party", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")))
    shards = n_shards or max(LEAST_SHARDS, -(-docs.count() // SHARD_ROWS))
    rows = rows.withColumn("shard", (
        F.conv(F.substring("ident", 1, 8), 16, 10).cast("long") % shards).cast("int"))
    sizes = materialize(rows.groupBy("party", "source", "shard").agg(
        F.sum("size").alias("shard_size")), "mix-shard-sizes")
    counted = sizes.groupBy("party", "source").agg(F.sum("shard_size").alias("source_size"))
    known = counted.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("words"),
                        F.count(F.lit(1)).alias("sources")).first()
    words, sources = known["words"], max(1, known["sources"])
    block = max(1, min(BLOCK_WORDS, words // (BLOCKS_PER_SOURCE * sources)))

    shares = capped_targets(counted.select("party", "source", "source_size"), weights, most) \
        .withColumn("all", F.lit(0)).withColumn("seats", F.lit((words + block // 2) // block))
    # A source is cut into equal blocks of about this size; what it won is counted in those.
    blocks = F.when(F.col("source_size") > 0, F.greatest(
        F.lit(1), F.round(F.col("source_size") / block))).otherwise(F.lit(0)).cast("long")
    shares = apportion(shares, ["all"], "target", "seats", "source_no") \
        .withColumn("blocks", blocks) \
        .withColumn("quota", F.when(F.col("source_size") > 0, F.least(F.col("blocks") * most, F.round(
            F.col("quota").cast("double") * block * F.col("blocks") / F.col("source_size")).cast("long")))
            .otherwise(F.lit(0))) \
        .select("party", "source_size", "target", "blocks", F.col("quota").alias("source_quota"))
    quotas = materialize(_shard_quotas(sizes, materialize(shares, "mix-shares"), seed), "mix-quotas")

    before = Window.partitionBy("party", "shard").orderBy("ident", "size", "tie") \
        .rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.withColumn("upto", F.sum("size").over(before)) \
        .join(quotas, ["party", "shard"], "left")
    begin = F.col("offset") + F.col("upto") - F.col("size")
    taken = F.when(F.col("size") > 0, _taken(begin, begin + F.col("size"))).otherwise(F.lit(0))
    # Before the row's own columns come back, which may have any names.
    return placed.withColumn("taken", taken.cast("long")).select("row.*", "size", "source_size", "target", "taken")


def _shard_quotas(sizes: DataFrame, shares: DataFrame, seed: int) -> DataFrame:
    """One row per source and shard: where its words and blocks begin, and its integer quota.

    A source's words lie end to end, shard after shard; block i of n covers words
    [i size / n, (i + 1) size / n). A block belongs to the shard its first word is in.
    """
    first = lambda at: _div(  # noqa: E731  the first block that begins at or after a word
        _times(at, F.col("blocks")) + (F.col("source_size") - 1).cast("decimal(19,0)"),
        F.col("source_size"))
    along = Window.partitionBy("party").orderBy("shard")
    sizes = sizes.drop("source").join(shares, "party") \
        .withColumn("offset", F.sum("shard_size").over(
            along.rowsBetween(Window.unboundedPreceding, 0)) - F.col("shard_size"))
    some = F.col("source_size") > 0
    cut = sizes.withColumn("first_block", F.when(some, first(F.col("offset"))).otherwise(F.lit(0))) \
        .withColumn("shard_blocks", F.when(some, first(F.col("offset") + F.col("shard_size")))
                    .otherwise(F.lit(0)) - F.col("first_block"))
    won = apportion(cut, ["party"], "shard_blocks", "source_quota", "shard")
    n = F.col("shard_blocks")
    mark = F.md5(F.concat_ws("|", F.lit(str(seed)), "party", F.col("shard").cast("string")))
    stride = F.lit(_STRIDES[2])
    for s in _STRIDES[1::-1]:
        stride = F.when(n % s != 0, F.lit(s)).otherwise(stride)
    seeded = won.withColumn("passes", F.when(n > 0, F.call_function("div", F.col("quota"), n))
                            .otherwise(F.lit(0))) \
        .withColumn("extra", F.when(n > 0, F.col("quota") % n).otherwise(F.lit(0))) \
        .withColumn("stride", stride.cast("long")) \
        .withColumn("turn", F.when(n > 0, F.conv(F.substring(mark, 1, 12), 16, 10).cast("long") % n)
                    .otherwise(F.lit(0)))
    # A shard's first words may lie in the last block of an earlier shard.
    carried = F.last(F.when(n > 0, _passes(F.col("first_block") + n - 1)), ignorenulls=True).over(
        along.rowsBetween(Window.unboundedPreceding, -1))
    return seeded.withColumn("carried", F.coalesce(carried, F.lit(0))).select(
        "party", "shard", "source_size", "target", "blocks", "offset", "first_block", "shard_blocks",
        "passes", "extra", "stride", "turn", "carried")


def _passes(block: Column) -> Column:
    """How often a block of its own shard is taken: the seeded order is a stride prime to the count."""
    n = F.col("shard_blocks")
    place = ((block - F.col("first_block")) % n * (F.col("stride") % n) % n + F.col("turn")) % n
    return F.col("passes") + F.when(place < F.col("extra"), F.lit(1)).otherwise(F.lit(0))


def _taken(begin: Column, end: Column) -> Column:
    """Words taken of a document that covers the source's words [begin, end)."""
    size, n = F.col("source_size"), F.col("blocks")
    of = lambda word: _div(_times(word + 1, n) - F.lit(1).cast("decimal(19,0)"), size)

    def add(total, block):
        lo = F.greatest(_div(_times(block, size), n), begin)
        hi = F.least(_div(_times(block + 1, size), n), end)
        often = F.when(block < F.col("first_block"), F.col("carried")).otherwise(_passes(block))
        return total + (hi - lo) * often

    return F.aggregate(F.sequence(of(begin), of(end - 1)), F.lit(0).cast("long"), add)
