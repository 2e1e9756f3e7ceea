"""Joining scores with labels and briefs: conviction, the combined view, tiers and trends.

Weights and pillar scales of the conviction score are not published anywhere; the defaults here are
this project's own choice and are arguments.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline import names
from plumbline.functions.expressions import calendar_quarter, col
from plumbline.operators.dedup import first_per_key

KEYS = (names.ENTITY, names.PERIOD)
DEFAULT_WEIGHTS = {"anomaly": 0.4, "quality": 0.3, "narrative": 0.3}
NARRATIVE_POINTS = {"CONTRADICTS": 100.0, "NEUTRAL": 25.0, "CORROBORATES": 0.0}


def outside_domain(labels: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Label rows whose value is missing or not one of the allowed ones."""
    return labels.where(col(column).isNull() | ~col(column).isin(list(allowed)))


def join_labels(
    filings: DataFrame, labels: DataFrame, column: str, allowed: Sequence[str],
    keys: Sequence[str] = KEYS, order: Sequence[Column] = (),
) -> DataFrame:
    """Every filing with its label row, if it has one within the domain (the first in ``order``).

    ``filings`` has unique keys, so the join neither multiplies rows nor gathers a key.
    """
    valid = labels.where(col(column).isin(list(allowed)))
    return filings.join(first_per_key(valid, keys, order), list(keys), "left")


def join_narrative(filings: DataFrame, narrative: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return join_labels(filings, narrative, "label", names.NARRATIVE_LABELS, keys)


def join_explanations(
    filings: DataFrame, explanations: DataFrame, keys: Sequence[str] = KEYS,
) -> DataFrame:
    return join_labels(filings, explanations, "pattern", names.PATTERNS, keys)


def eligible(df: DataFrame, score: str, threshold: float = 5.0) -> DataFrame:
    """Filings whose alert score reaches the threshold."""
    return df.where(col(score) >= F.lit(threshold))


def tier_of(score: Column) -> Column:
    """ALERT, FLAG or WATCH by the floor of each tier; below all of them there is no tier."""
    tier = F.lit(None).cast("string")
    for name, floor in sorted(names.TIER_FLOORS.items(), key=lambda item: item[1]):
        tier = F.when(score >= F.lit(floor), F.lit(name)).otherwise(tier)
    return tier


def conviction_scores(
    scores: DataFrame, quality: DataFrame, narrative: DataFrame,
    weights: Mapping[str, float] = DEFAULT_WEIGHTS,
    narrative_points: Mapping[str, float] = NARRATIVE_POINTS, keys: Sequence[str] = KEYS,
) -> DataFrame:
    """Key, `conviction_score` (0-100) and `tier` of every filing.

    Pillars: the anomaly score, 100 for a likely manipulator, and points for the narrative label.
    A pillar without data adds nothing.
    """
    key_columns = [col(k) for k in keys]
    base = scores.select(*key_columns, F.col("anomaly_score_0_100"))
    flags = first_per_key(quality.select(*key_columns, F.col("likely_manipulator")), keys)
    joined = join_narrative(
        base.join(flags, list(keys), "left"),
        narrative.select(*key_columns, F.col("label")), keys)
    points = F.lit(0.0)
    for label, amount in narrative_points.items():
        points = F.when(F.col("label") == label, F.lit(float(amount))).otherwise(points)
    conviction = (
        F.lit(float(weights["anomaly"])) * F.coalesce(F.col("anomaly_score_0_100"), F.lit(0.0))
        + F.lit(float(weights["quality"]))
        * F.when(F.col("likely_manipulator"), F.lit(100.0)).otherwise(F.lit(0.0))
        + F.lit(float(weights["narrative"])) * points)
    rounded = F.round(conviction, 4)
    return joined.select(
        *key_columns, rounded.alias("conviction_score"), tier_of(rounded).alias("tier"))


def filing_intelligence(
    scores: DataFrame, explanations: DataFrame, narrative: DataFrame, conviction: DataFrame,
    keys: Sequence[str] = KEYS, view: str | None = None,
) -> DataFrame:
    """One row per filing with the columns of all four tables, a clash prefixed by its table.

    With ``view`` the result is also registered as a temporary view of that name.
    """
    joined = scores
    parts = {"explanation": (explanations, "pattern", names.PATTERNS),
             "narrative": (narrative, "label", names.NARRATIVE_LABELS),
             "conviction": (conviction, None, None)}
    for prefix, (table, column, allowed) in parts.items():
        renamed = table.select(*[
            col(c).alias(c if c in keys or c not in joined.columns else f"{prefix}_{c}")
            for c in table.columns])
        if column is None:
            joined = joined.join(first_per_key(renamed, keys), list(keys), "left")
        else:
            named = column if column in renamed.columns else f"{prefix}_{column}"
            joined = join_labels(joined, renamed, named, allowed, keys)
    if view:
        joined.createOrReplaceTempView(view)
    return joined


def tiered_pack(intelligence: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Filings with a tier, highest conviction first."""
    return intelligence.where(F.col("tier").isNotNull()).orderBy(
        F.col("conviction_score").desc(), *[col(k) for k in keys])


def company_trend(
    intelligence: DataFrame, entity: str = names.ENTITY, period: str = names.PERIOD,
    filed: str = "filing_date",
) -> DataFrame:
    """One row per entity and calendar quarter, the latest filed, clustered by entity.

    Ranges over (entity, quarter) keep an entity's rows together on disk without forcing a very
    long history into one task.
    """
    quarterly = intelligence.withColumn("calendar_quarter", calendar_quarter(col(period)))
    latest = first_per_key(
        quarterly, [entity, "calendar_quarter"],
        [col(filed).desc_nulls_last(), col(period).desc_nulls_last()])
    return latest.repartitionByRange(entity, "calendar_quarter").sortWithinPartitions(
        entity, "calendar_quarter")


def save_trend(
    trend: DataFrame, table: str, path: str | None = None, buckets: int | None = None,
    entity: str = names.ENTITY, quarter: str = "calendar_quarter",
) -> DataFrame:
    """Save `company_trend` as a table in folders by quarter, bucketed and sorted by entity.

    Later joins and windows on the entity read the buckets as they lie, without a shuffle, and a filter on
    quarters reads their folders alone. An entity has one row a quarter, so no bucket grows out of hand.
    ``path`` makes it an external table. A table of that name is replaced.
    """
    spark = trend.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Dealt by the hash that deals the buckets: every task writes one bucket.
    writer = trend.repartition(n, col(entity)).write.mode("overwrite").format("parquet") \
        .partitionBy(quarter).bucketBy(n, entity).sortBy(entity)
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return spark.table(table)
