"""Per-row summaries of the z-scores: mean strengths, and which features drive a score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline import names
from plumbline.functions.expressions import (
    col, count_present, driver_summary, largest_by_magnitude, mean_abs_present,
)


def summary_scores(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Add the mean absolute self, peer and combined score, and how many combined scores exist."""
    def named(of):
        return [col(of(f)) for f in features]

    return df.select(
        "*",
        mean_abs_present(named(names.self_z)).alias("self_history_score"),
        mean_abs_present(named(names.peer_z)).alias("peer_relative_score"),
        mean_abs_present(named(names.combined_z)).alias("combined_signal_strength"),
        count_present(named(names.combined_z)).alias("num_features_used"),
    )


def top_drivers(df: DataFrame, features: Sequence[str], n: int = names.N_DRIVERS) -> DataFrame:
    """Add `top_driver_i` and `top_driver_i_value`; slots beyond the present scores stay missing."""
    best = largest_by_magnitude([(f, col(names.combined_z(f))) for f in features], n)
    ranked = df.withColumn("__drivers", best)
    slots = []
    for i in range(n):
        entry = F.get(F.col("__drivers"), F.lit(i))
        slots += [
            entry.getField("name").alias(f"top_driver_{i + 1}"),
            F.round(entry.getField("value"), 4).alias(f"top_driver_{i + 1}_value"),
        ]
    return ranked.select(*[col(c) for c in df.columns], *slots)


def with_driver_summary(df: DataFrame, n: int = names.N_DRIVERS) -> DataFrame:
    """Add `driver_summary`, skipping driver slots the table does not have."""
    slots = [i for i in range(1, n + 1)
             if f"top_driver_{i}" in df.columns and f"top_driver_{i}_value" in df.columns]
    text = driver_summary(slots) if slots else F.lit("")
    return df.withColumn("driver_summary", text)
