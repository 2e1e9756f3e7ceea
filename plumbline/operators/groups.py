"""Group sizes, hot groups, and attaching one row of statistics to every row of its group.

A hot group is one with more rows than a single task should hold. Its statistics are found by
partial aggregation only (`quantiles.py`), and its rows are spread over all tasks when statistics
are attached, so a group holding a third of the data costs no more per task than any other.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.expressions import col
from plumbline.session import BROADCAST_BYTES, materialize

# Rows x features one task may hold for one group (about 64 bytes of aggregate state per cell, and
# Spark keeps up to 128 groups side by side before it sorts them).
GROUP_CELLS = 500_000
# Salt values for hot rows; also the number of copies of a table too large to broadcast.
SPREAD = 1 << 20
COPIES = 32


@dataclass(frozen=True)
class GroupSizes:
    """What the driver knows about a grouping: a handful of numbers and a table of hot keys."""

    by: tuple[str, ...]
    n_groups: int
    n_rows: int
    n_hot: int
    n_hot_rows: int
    hot: DataFrame | None
    largest: int = 0  # rows of the largest group that is not hot


def all_present(by: Sequence[str]) -> Column:
    present = F.lit(True)
    for name in by:
        present = present & col(name).isNotNull()
    return present


def by_grouping(
    df: DataFrame, groupings: Sequence[Sequence[str]], payload: Sequence[str] = (),
    taken: Sequence[Column] | None = None,
) -> tuple[DataFrame, list[str]]:
    """One row for each row of ``df`` and grouping whose keys it has: ``__grouping``, all groupings' keys
    (null where a grouping has no such key) and the payload; and the names of the keys.

    ``taken`` limits each grouping to the rows where its condition holds.
    """
    keys = list(dict.fromkeys(c for by in groupings for c in by))
    taken = taken or [F.lit(True)] * len(groupings)
    held = [all_present(by) & t for by, t in zip(groupings, taken)]
    if len(groupings) == 1:
        return df.where(held[0]).select(
            F.lit(0).alias("__grouping"), *[col(c) for c in keys], *[col(c) for c in payload]), keys
    kinds = {f.name: f.dataType for f in df.schema.fields}
    entries = [F.when(h, F.struct(F.lit(i).alias("__grouping"), *[
        (col(c) if c in by else F.lit(None).cast(kinds[c])).alias(c) for c in keys]))
        for i, (by, h) in enumerate(zip(groupings, held))]
    rows = df.select(*[col(c).alias(f"__p{i}") for i, c in enumerate(payload)], F.inline(F.array(*entries)))
    return rows.where(F.col("__grouping").isNotNull()).select(
        "__grouping", *[col(c) for c in keys], *[F.col(f"__p{i}").alias(c) for i, c in enumerate(payload)]), keys


def group_sizes(df: DataFrame, by: Sequence[str], width: int, cells: int = GROUP_CELLS) -> GroupSizes:
    """Count groups and find the hot ones; rows with a missing key belong to no group."""
    return groupings_sizes(df, [by], width, cells)[0]


def groupings_sizes(
    df: DataFrame, groupings: Sequence[Sequence[str]], width: int, cells: int = GROUP_CELLS,
) -> list[GroupSizes]:
    """``group_sizes`` of several groupings from one pass."""
    hot_rows = max(1, cells // max(1, width))
    rows, keys = by_grouping(df, groupings)
    sizes = rows.groupBy("__grouping", *[col(c) for c in keys]).agg(F.count(F.lit(1)).alias("__rows"))
    is_hot = F.col("__rows") > hot_rows
    seen = {r["__grouping"]: r for r in sizes.groupBy("__grouping").agg(
        F.count(F.lit(1)).alias("groups"), F.sum("__rows").alias("rows"), F.count_if(is_hot).alias("hot"),
        F.coalesce(F.sum(F.when(is_hot, F.col("__rows"))), F.lit(0)).alias("hot_row_count"),
        F.coalesce(F.max(F.when(~is_hot, F.col("__rows"))), F.lit(0)).alias("largest")).collect()}
    out = []
    for i, by in enumerate(groupings):
        if i not in seen:
            out.append(GroupSizes(tuple(by), 0, 0, 0, 0, None))
            continue
        hot = None
        if seen[i]["hot"]:
            hot = materialize(sizes.where((F.col("__grouping") == i) & is_hot)
                              .select(*[col(c) for c in by]), "hot-keys")
        out.append(GroupSizes(tuple(by), seen[i]["groups"], seen[i]["rows"], seen[i]["hot"],
                              seen[i]["hot_row_count"], hot, seen[i]["largest"]))
    return out


def fits_broadcast(rows: int, row_bytes: int) -> bool:
    return rows * row_bytes <= BROADCAST_BYTES


def attach_small(
    df: DataFrame, table: DataFrame, by: Sequence[str], rows: int, row_bytes: int, how: str = "left",
) -> DataFrame:
    """Join a table of few rows to every row of its group, whatever the group sizes are.

    Broadcast when the counted size allows it. Otherwise each table row is copied once per salt and
    the large side is salted by row content, so a hot key is spread over ``COPIES`` tasks.

    The copies must not be broadcast after all: Spark estimates them by the written size of the table.
    """
    if fits_broadcast(rows, row_bytes):
        return df.join(F.broadcast(table), list(by), how)
    salted = df.withColumn("__salt", _row_salt(df, COPIES))
    copies = table.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))))
    return salted.join(copies.hint("merge"), [*by, "__salt"], how).drop("__salt")


def attach_counted(
    df: DataFrame, table: DataFrame, key: str, rows: int, row_bytes: int, members: str, hot_rows: int = GROUP_CELLS,
) -> DataFrame:
    """Inner `attach_small` for a table that knows in ``members`` how many rows of ``df`` each key has: only
    keys with more than ``hot_rows`` are copied."""
    if fits_broadcast(rows, row_bytes):
        return df.join(F.broadcast(table), key)
    is_hot = F.col(members) > hot_rows
    hot = table.where(is_hot).select(col(key), F.lit(True).alias("__hot"))
    salted = df.join(F.broadcast(hot), key, "left").withColumn(
        "__salt", F.when(F.col("__hot"), _row_salt(df, COPIES)).otherwise(F.lit(0)))
    copies = table.withColumn("__salt", F.explode(F.sequence(
        F.lit(0), F.when(is_hot, F.lit(COPIES - 1)).otherwise(F.lit(0)))))
    return salted.join(copies.hint("merge"), [key, "__salt"]).drop("__salt", "__hot")


def _row_salt(df: DataFrame, buckets: int) -> Column:
    hashable = [col(f.name) for f in df.schema.fields
                if f.dataType.typeName() not in ("map", "variant")]
    return F.pmod(F.xxhash64(*hashable), F.lit(buckets)).cast("int")
