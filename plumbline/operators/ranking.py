"""Percentile scores over all rows, ordering and top-N."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline import names
from plumbline.functions.expressions import col, finite
from plumbline.operators.groups import SPREAD, fits_broadcast
from plumbline.session import BROADCAST_BYTES, materialize

# Distinct values per range; a range is ranked by one task.
RANGE_VALUES = 1_000_000
# Values held by more rows than this are spread when ranks are joined back.
HOT_VALUE_ROWS = 1_000_000


def average_ranks(
    df: DataFrame, value: str, range_values: int = RANGE_VALUES,
) -> tuple[DataFrame, int, int]:
    """Distinct present values with their row count and average rank; plus how many rows and values.

    Rows collapse to distinct values with counts before anything is ordered, so ties cost nothing.
    The distinct values are cut into value ranges: each range is summed on its own, and a range starts
    from the total of the ranges before it, of which there is one row per range.
    """
    known = finite(col(value))
    counts = materialize(
        df.where(known.isNotNull()).groupBy(known.alias("value"))
        .agg(F.count(F.lit(1)).alias("copies")), "value-counts")
    seen = counts.agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("rows"),
                      F.count(F.lit(1)).alias("values")).first()
    ranges = max(2, -(-seen["values"] // range_values))
    placed = materialize(
        counts.repartitionByRange(ranges, "value")
        .withColumn("range", F.spark_partition_id()), "value-ranges")
    totals = placed.groupBy("range").agg(F.sum("copies").alias("total"))
    offsets = totals.withColumn("offset", F.coalesce(F.sum("total").over(
        Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    within = Window.partitionBy("range").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    running = placed.join(F.broadcast(offsets.select("range", "offset")), "range").withColumn(
        "through", F.col("offset") + F.sum("copies").over(within))
    ranked = running.select(
        "value", "copies",
        (F.col("through").cast("double") - (F.col("copies").cast("double") - 1.0) / 2.0)
        .alias("average_rank"))
    return ranked, seen["rows"], seen["values"]


def percentile_scores(
    df: DataFrame, value: str = "mahalanobis_distance", out: str = "anomaly_score_0_100",
    range_values: int = RANGE_VALUES, hot_value_rows: int = HOT_VALUE_ROWS,
    row_bytes: int = 32,
) -> DataFrame:
    """Add 100 * average rank / number of present values, rounded to 4; missing stays missing.

    The ranks are joined back by value: broadcast while few distinct values exist, otherwise by a
    shuffle in which rows of very frequent values are spread over all tasks.
    """
    ranked, n_rows, n_values = average_ranks(df, value, range_values)
    scores = ranked.select(
        F.col("value").alias("__value"), "copies",
        F.round(F.col("average_rank") / F.lit(float(max(1, n_rows))) * 100.0, 4).alias(out))
    kept = [col(c) for c in df.columns if c != out]
    if fits_broadcast(n_values, row_bytes):
        joined = df.drop(out).join(
            F.broadcast(scores.drop("copies")), col(value) == F.col("__value"), "left")
        return joined.select(*kept, F.col(out))

    scores = materialize(scores, "value-scores")
    # Fewer than n_rows / floor values are this frequent, which keeps their table within bounds.
    floor = max(hot_value_rows, n_rows * row_bytes // BROADCAST_BYTES)
    frequent = F.broadcast(scores.where(F.col("copies") > floor).select(
        "__value", F.col(out).alias("__hot_score")))
    scalar = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    spread = F.pmod(F.xxhash64(*[col(c) for c in scalar]), F.lit(SPREAD)).cast("int")
    marked = (
        df.drop(out).join(frequent, col(value) == F.col("__value"), "left").drop("__value")
        .withColumn("__salt", F.when(
            F.col("__hot_score").isNotNull() | col(value).isNull(), F.lit(1) + spread)
            .otherwise(F.lit(0)))
    )
    rest = scores.select("__value", out).withColumn("__zero", F.lit(0))
    joined = marked.join(
        rest, (col(value) == F.col("__value")) & (F.col("__salt") == F.col("__zero")), "left")
    return joined.select(*kept, F.coalesce(F.col("__hot_score"), F.col(out)).alias(out))


def ordered_scores(
    df: DataFrame, score: str = "anomaly_score_0_100",
    ties: Sequence[str] = (names.ENTITY, names.PERIOD), distance: str = "mahalanobis_distance",
) -> DataFrame:
    """Highest score first, missing last; equal scores by distance where there is one, then by key.

    Scores are rounded, so among very many rows equal ones are the rule.
    """
    further = [col(distance).desc_nulls_last()] if distance in df.columns else []
    return df.orderBy(col(score).desc_nulls_last(), *further, *[col(t) for t in ties])


def top_n(
    df: DataFrame, n: int = names.TOP_N, score: str = "anomaly_score_0_100",
    ties: Sequence[str] = (names.ENTITY, names.PERIOD), distance: str = "mahalanobis_distance",
) -> DataFrame:
    """The n highest scores; Spark keeps n rows per task and never sorts the table."""
    return ordered_scores(df, score, ties, distance).limit(n)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """First rows of a score table or review pack, the columns a person looks at first."""
    return ordered_scores(df).select(
        names.ENTITY, names.PERIOD, "anomaly_score_0_100", "top_driver_1", "top_driver_1_value"
    ).limit(n)
