"""Robust squared Mahalanobis distance with a Minimum Covariance Determinant fit.

The fit follows the published FAST-MCD scheme with nested subsets. All rows are dealt into buckets by a
hash of their features; random starts run in every bucket in parallel; the best starts of all buckets
then take concentration steps over all rows, several candidates in one scan (`concentration.py`). The best
goes on until its determinant no longer falls. A consistency factor and one reweighting pass over all rows
give the final location and shape. The driver holds p-by-p matrices and a bounded number of rows.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline import names
from plumbline.functions.chi2 import chi2_quantile
from plumbline.functions.expressions import col, finite
from plumbline.functions.matrix import concentrate, squared_distances, whitening
from plumbline.operators.concentration import moments_within, nearest_moments, settled_in_task, steps_around
from plumbline.operators.groups import GROUP_CELLS
from plumbline.operators.quantiles import column_quantiles
from plumbline.operators.winsor import squared_norm
from plumbline.session import materialize

# Distinct rows in a bucket of random starts, and starts over all buckets; no bucket has fewer than
# LEAST_STARTS. Two steps tell a good start from a bad one.
BUCKET_ROWS = 1_500
N_STARTS = 500
LEAST_STARTS = 10
START_STEPS = 2
# Starts of all buckets that take CANDIDATE_STEPS steps over all rows together; the best goes on alone.
N_KEPT = 10
CANDIDATE_STEPS = 2
# The rows around the cut that one task takes steps with, in times the cells of a group it may hold.
BAND_TIMES = 8
# A fit that still improves after so many steps over all rows is reported.
EXPECTED_STEPS = 200


@dataclass(frozen=True)
class Shape:
    """Location and whitening matrix: distance = |whiten @ (x - location)|^2."""

    features: tuple[str, ...]
    location: np.ndarray
    whiten: np.ndarray
    logdet: float
    n_rows: int
    steps: int = 0

    def distance(self) -> Column:
        """Squared distance of a row as a column, computed on Arrow batches."""
        location, whiten = self.location, self.whiten

        @F.pandas_udf("double")
        def batch_distance(*columns: pd.Series) -> pd.Series:
            return pd.Series(squared_distances(np.column_stack(columns), location, whiten))

        return batch_distance(*[col(f) for f in self.features])


def _best_starts(rows: DataFrame, features: Sequence[str], support_fraction: float, seed: int):
    """(location, covariance, expected cut) of the best random starts of all buckets.

    Equal rows are counted once with their copies, so a bucket is bounded however often a row repeats.
    Few buckets are given to several tasks each, which share the starts.
    """
    p = len(features)
    distinct = materialize(rows.groupBy(*[col(f) for f in features]).agg(
        F.count(F.lit(1)).cast("double").alias("__copies")), "distinct-rows")
    buckets = max(1, distinct.count() // max(BUCKET_ROWS, 10 * p))
    shares = max(1, math.ceil(rows.sparkSession.sparkContext.defaultParallelism / buckets))
    starts = max(LEAST_STARTS, math.ceil(N_STARTS / buckets))
    each = math.ceil(starts / shares)
    order = [*features, "__copies"]

    def begin(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        bucket, share = (int(k) for k in key)
        values = group[order].sort_values(order).to_numpy(dtype=float)
        points, copies = values[:, :p], values[:, p]
        n, h = len(points), max(p + 1.0, math.floor(support_fraction * copies.sum()))
        found = []
        for start in range(share * each, min(starts, (share + 1) * each) if n > p else 0):
            pick = np.random.default_rng([seed, bucket, start]).permutation(n)
            size = p + 1
            # A subset without full rank grows until it has one, as the published scheme does.
            while size < min(n, 2 * p + 10) and np.linalg.matrix_rank(np.cov(points[pick[:size]].T)) < p:
                size += 1
            logdet, location, covariance = concentrate(points, copies, pick[:size], h, START_STEPS)
            found.append((bucket, start, logdet, location.tolist(), covariance.ravel().tolist()))
        found = sorted(found, key=lambda f: (f[2], f[1]))[:N_KEPT]
        cuts = []  # the distance of the h-th of the bucket's rows
        for *_, location, covariance in found:
            whiten, _ = whitening(np.asarray(covariance).reshape(p, p))
            d = squared_distances(points, np.asarray(location), whiten)
            near = np.argsort(d)
            cuts.append(float(d[near][min(n - 1, np.searchsorted(np.cumsum(copies[near]), h))]))
        return pd.DataFrame(found, columns=["bucket", "start", "logdet", "location", "covariance"]).assign(cut=cuts)

    dealt = distinct.withColumn("__bucket", F.pmod(
        F.xxhash64(F.lit(seed), *[col(f) for f in features]), F.lit(buckets))) \
        .withColumn("__share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
    tried = dealt.groupBy("__bucket", "__share").applyInPandas(
        begin, "bucket long, start int, logdet double, location array<double>, "
        "covariance array<double>, cut double")
    best = tried.orderBy("logdet", "bucket", "start").limit(N_KEPT).collect()
    return [(np.asarray(b["location"]), np.asarray(b["covariance"]).reshape(p, p), b["cut"]) for b in best]


def fit_shape(
    rows: DataFrame, features: Sequence[str], n_rows: int,
    support_fraction: float = names.SUPPORT_FRACTION, random_state: int = names.SEED,
    cells: int = GROUP_CELLS,
) -> Shape:
    """Fit location and shape to complete rows (no missing features), at least p + 1 of them.

    Rows take part by their features alone; other columns and the partitioning have no say.
    """
    features, p = tuple(features), len(features)
    rows = rows.select(*[col(f) for f in features])

    def shape(location, covariance, steps):
        whiten, logdet = whitening(covariance)
        return Shape(features, location, whiten, logdet, n_rows, steps)

    h = max(p + 1, min(n_rows, int(support_fraction * n_rows)))

    def step(fits):
        """Shapes and guesses of their cuts after one step from the given ones."""
        found = nearest_moments(rows, [(s.location, s.whiten) for s, *_ in fits], h, [g for _, *g in fits])
        following = []
        for (before, *_), f in zip(fits, found):
            after = shape(f.location, f.covariance, before.steps + 1)
            # A smaller shape measures the same rows as farther away.
            grows = math.exp(min(50.0, (before.logdet - after.logdet) / p)) \
                if math.isfinite(before.logdet) and math.isfinite(after.logdet) else 1.0
            following.append((after, f.cut * grows, f.density / grows))
        return following

    def settled(starts):
        candidates = [(shape(location, covariance, 0), cut, 0.0) for location, covariance, cut in starts]
        for _ in range(CANDIDATE_STEPS):
            candidates = step(candidates)
        best = min(candidates, key=lambda c: c[0].logdet)
        # To the fixed point: a step that does not lower the determinant repeats the same rows.
        while best[0].logdet > float("-inf"):
            now, guess, density = best
            walked = steps_around(rows, now.location, now.whiten, now.logdet, h, n_rows, guess, density,
                                  cells * BAND_TIMES) if math.isfinite(now.logdet) else None
            if walked is None:
                following = step([best])[0]
                if following[0].logdet >= now.logdet - 1e-12 * max(1.0, abs(now.logdet)):
                    break
            elif walked.taken:
                following = (shape(walked.location, walked.covariance, now.steps + walked.taken), walked.cut, walked.density)
            best = following if walked is None or walked.taken else best
            if best[0].steps // EXPECTED_STEPS > now.steps // EXPECTED_STEPS:
                warnings.warn(f"the robust fit still improves after {best[0].steps} steps", stacklevel=2)
            if walked is not None and walked.done:
                break
        return best[0]

    starts = _best_starts(rows, features, support_fraction, random_state)
    if n_rows * p <= cells:  # few enough for one task, which takes all steps at once
        current = shape(*settled_in_task(rows, [s[:2] for s in starts], h, CANDIDATE_STEPS))
    else:
        current = settled(starts)
    measured = column_quantiles(
        rows.select(current.distance().alias("d")), ["d"], [0.5], cells, n_rows=n_rows)["d"][1][0]
    factor = measured / chi2_quantile(0.5, p)
    if factor > 0:
        # Rows strictly nearer than the cut-off.
        found = moments_within(rows, current.location, current.whiten, factor * chi2_quantile(0.975, p))
        current = shape(found.location, found.covariance, current.steps)
    return current


def with_filled(df: DataFrame, medians: Mapping[str, float | None]) -> DataFrame:
    """Add `__f_*`: each feature that has a median, as a number, its holes filled with the median."""
    return df.select("*", *[
        F.coalesce(finite(col(f)), F.lit(m)).alias(f"__f_{f}") for f, m in medians.items() if m is not None])


def robust_distance(
    staged: DataFrame, ranges: Mapping[str, tuple[float, float, float] | None],
    support_fraction: float = names.SUPPORT_FRACTION, random_state: int = names.SEED,
    out: str = "mahalanobis_distance", cells: int = GROUP_CELLS,
) -> DataFrame:
    """The robust distance of a written table with filled features (`with_filled`), which it drops.

    The fit passes over the table many times and reads nothing but the filled features.
    """
    used = [f for f, r in ranges.items() if r is not None]
    varying = [f for f in used if ranges[f][0] != ranges[f][2]]
    kept = [col(c) for c in staged.columns if c != out and c not in {f"__f_{f}" for f in used}]
    if not used:
        return staged.select(*kept, F.lit(None).cast("double").alias(out))
    n_rows = staged.count()
    if n_rows < len(used) + 1:
        return squared_norm(staged, [f"__f_{f}" for f in used], out).select(*kept, F.col(out))
    if not varying:
        return staged.select(*kept, F.lit(0.0).alias(out))
    fitted = fit_shape(
        staged, [f"__f_{f}" for f in varying], n_rows, support_fraction, random_state, cells)
    return staged.withColumn(out, fitted.distance()).select(*kept, F.col(out))


def robust_mahalanobis(
    df: DataFrame, features: Sequence[str], support_fraction: float = names.SUPPORT_FRACTION,
    random_state: int = names.SEED, out: str = "mahalanobis_distance", cells: int = GROUP_CELLS,
    ranges: Mapping[str, tuple[float, float, float] | None] | None = None,
) -> DataFrame:
    """Add the robust squared distance of every row, missing features filled with their median.

    Features that are missing everywhere take no part. With fewer rows than features + 1 the
    distance is the sum of squares. A feature with one value throughout adds nothing to any distance
    and stays out of the fit.

    Pass ``ranges`` (least value, median, greatest value per feature, None if wholly missing) when
    they are known.
    """
    if ranges is None:
        found = column_quantiles(df, features, [0.0, 0.5, 1.0], cells)
        ranges = {f: tuple(q) if n else None for f, (n, q) in found.items()}
    staged = materialize(
        with_filled(df, {f: ranges[f] and ranges[f][1] for f in features}), "filled-features")
    return robust_distance(
        staged, {f: ranges[f] for f in features}, support_fraction, random_state, out, cells)
