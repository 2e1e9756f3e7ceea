"""Dataset-wide limits and medians of the features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline import names
from plumbline.functions.expressions import clip, col, finite, total_of
from plumbline.operators.groups import GROUP_CELLS
from plumbline.operators.quantiles import column_quantiles


def winsor_bounds(
    df: DataFrame, features: Sequence[str], lower: float = names.WINSOR_LOWER,
    upper: float = names.WINSOR_UPPER, cells: int = GROUP_CELLS,
) -> dict[str, tuple[float, float] | None]:
    """Lower and upper percentile of every feature; None for a feature that is missing everywhere."""
    found = column_quantiles(df, features, [lower, upper], cells)
    return {f: tuple(q) if n else None for f, (n, q) in found.items()}


def apply_bounds(df: DataFrame, bounds: dict[str, tuple[float, float] | None]) -> DataFrame:
    return df.select(*[
        clip(finite(col(c)), *bounds[c]).alias(c) if bounds.get(c) else col(c) for c in df.columns])


def winsorize(
    df: DataFrame, features: Sequence[str], lower: float = names.WINSOR_LOWER,
    upper: float = names.WINSOR_UPPER,
) -> DataFrame:
    """Clip every feature to its own percentiles; missing stays missing.

    The bounds are two numbers per feature, so they go into the plan as literals and the rows stay
    where they are: no join and no shuffle.
    """
    return apply_bounds(df, winsor_bounds(df, features, lower, upper))


def feature_medians(
    df: DataFrame, features: Sequence[str], cells: int = GROUP_CELLS,
) -> dict[str, float | None]:
    found = column_quantiles(df, features, [0.5], cells)
    return {f: q[0] if n else None for f, (n, q) in found.items()}


def fill_medians(df: DataFrame, medians: dict[str, float | None]) -> DataFrame:
    return df.select(*[
        F.coalesce(finite(col(c)), F.lit(medians[c])).alias(c) if medians.get(c) is not None else col(c)
        for c in df.columns])


def impute_medians(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Replace missing features by the feature's median; a wholly missing feature stays missing."""
    return fill_medians(df, feature_medians(df, features))


def squared_norm(
    df: DataFrame, features: Sequence[str], out: str = "mahalanobis_distance",
    medians: dict[str, float | None] | None = None,
) -> DataFrame:
    """Sum of squared features, the distance used when there are too few rows to fit a shape.

    Missing features count as their medians where those are given; a feature without a median, missing
    everywhere, takes no part.
    """
    known = {f: finite(col(f)) for f in features}
    if medians is not None:
        known = {f: F.coalesce(value, F.lit(medians[f])) for f, value in known.items()
                 if medians.get(f) is not None}
    if not known:
        return df.withColumn(out, F.lit(None).cast("double"))
    return df.withColumn(out, total_of([value * value for value in known.values()]))
