"""Quantile and distinct-count sketches, for those who choose speed over exact figures.

A sketch is a small binary value per group. It is kept beside the data, merged with the sketches of new rows,
and read without the rows: daily sketches add up to a year's without another scan. Everything exact in this
library stays exact; nothing else uses these.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.expressions import col, finite

# Values a quantile sketch keeps; the rank error of 800 is below half a percent.
SKETCH_K = 800
# Registers of a distinct sketch as a power of two; the standard error of 14 is below one percent.
SKETCH_LG = 14


def quantile_sketches(
    df: DataFrame, by: Sequence[str], features: Sequence[str], k: int = SKETCH_K,
) -> DataFrame:
    """One row per group: a sketch per feature, named like it. Missing values, NaN and infinities are left
    out; a feature without a value in a group has a missing sketch."""
    value = {f: finite(col(f)) for f in features}
    return df.groupBy(*[col(c) for c in by]).agg(*[
        F.when(F.count(value[f]) > 0, F.kll_sketch_agg_double(value[f], k)).alias(f) for f in features])


def merged_quantile_sketches(sketches: DataFrame, by: Sequence[str], features: Sequence[str],
                             k: int = SKETCH_K) -> DataFrame:
    """Sketches of coarser groups, or of old and new rows together (union them first)."""
    return sketches.groupBy(*[col(c) for c in by]).agg(*[
        F.when(F.count(col(f)) > 0, F.kll_merge_agg_double(col(f), k)).alias(f) for f in features])


def sketched_quantiles(sketches: DataFrame, by: Sequence[str], features: Sequence[str],
                       probs: Sequence[float]) -> DataFrame:
    """Rows (by, feature, n, prob, value) read off the sketches."""
    long = sketches.unpivot([col(c) for c in by], [col(f) for f in features], "feature", "sketch") \
        .where(F.col("sketch").isNotNull())
    return long.select(
        *[col(c) for c in by], "feature", F.kll_sketch_get_n_double("sketch").alias("n"),
        F.explode(F.array(*[F.struct(
            F.lit(float(p)).alias("prob"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias("value"))
            for p in probs])).alias("at")).select(*[col(c) for c in by], "feature", "n", "at.prob", "at.value")


def distinct_sketches(df: DataFrame, by: Sequence[str], column: str, lg: int = SKETCH_LG) -> DataFrame:
    """One row per group with a `sketch` of the distinct values of a column; missing ones do not count."""
    return df.where(col(column).isNotNull()).groupBy(*[col(c) for c in by]).agg(
        F.hll_sketch_agg(col(column).cast("string"), lg).alias("sketch"))


def sketched_distinct(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Estimated distinct values over the united sketches of each coarser group."""
    return sketches.groupBy(*[col(c) for c in by]).agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_distinct"))
