"""Feature maps of any width: one row per filing and present feature instead of one column per feature.

The layout has no limit on the number of features, and its cost follows the values that are there. Limits,
medians, z-scores, summaries, drivers and the plain distance are those of the wide layout, with one
difference: a feature that a filing lacks has no row, so it has no score of 0 in a group without spread,
where the wide layout gives one. The distance fills such features with their median all the same: the
medians' squares are summed once, and each filing adds what its own values change.

Every statistic is taken within a feature, so one shuffle by feature serves the limits and both groupings, and
one by filing the summaries and the drivers. Features with more cells than a task should hold take the way of
hot groups (`quantiles.py`).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline import names
from plumbline.functions.expressions import blend, clip, col, finite
from plumbline.operators.groups import GROUP_CELLS, all_present, attach_small, group_sizes
from plumbline.operators.quantiles import attach_group_stats, group_quantiles, groupings_quantiles, n_col, q_col
from plumbline.operators.ranking import percentile_scores
from plumbline.operators.zscores import QUARTILES, attach_zscores
from plumbline.session import materialize

NAME, VALUE = "feature", "value"
# Buckets of features that are counted before features are: only a bucket with many cells has one of many.
BUCKETS = 1 << 16
# Cells scored at a time in a task, and those of the feature that ends last.
TASK_CELLS = 100_000
_HASH, _BASE = "__hash", "__base"


def limited_cells(
    cells: DataFrame, keys: Sequence[str], lower: float = names.WINSOR_LOWER, upper: float = names.WINSOR_UPPER,
    limit: int = GROUP_CELLS,
) -> DataFrame:
    """Present cells (keys, feature, value) with values limited to their feature's percentiles, and the
    feature's `median`."""
    present = cells.select(*[col(k) for k in keys], col(NAME), finite(col(VALUE)).alias(VALUE)) \
        .where(F.col(VALUE).isNotNull())
    joined = attach_group_stats(present, group_quantiles(present, [NAME], [VALUE], [lower, 0.5, upper], limit))
    at = lambda i: F.get(col(q_col(VALUE)), F.lit(i))
    return joined.select(*[col(k) for k in keys], col(NAME), clip(F.col(VALUE), at(0), at(2)).alias(VALUE),
                         at(1).alias("median"), col(n_col(VALUE)).alias("n_feature"))


def split_by_size(cells: DataFrame, limit: int = GROUP_CELLS) -> tuple[DataFrame, DataFrame | None]:
    """Cells of the features with at most ``limit`` cells, and of the others, if there are any."""
    bucket = F.pmod(F.xxhash64(col(NAME)), F.lit(BUCKETS))
    full = materialize(cells.groupBy(bucket.alias("__bucket")).agg(F.count(F.lit(1)).alias("__cells")).where(
        F.col("__cells") > limit).select("__bucket"), "full-buckets")
    if not full.limit(1).count():
        return cells, None
    # At most BUCKETS rows.
    sizes = group_sizes(cells.select(NAME).join(F.broadcast(full), bucket == F.col("__bucket"), "left_semi"), [NAME], 1, limit)
    if not sizes.n_hot:
        return cells, None
    marked = attach_small(cells, sizes.hot.withColumn("__hot", F.lit(True)), [NAME], sizes.n_hot, 64)
    return tuple(marked.where(c).drop("__hot") for c in (F.col("__hot").isNull(), F.col("__hot").isNotNull()))


def _whole_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows that come ordered by the hash of their feature, in tables that part no feature."""
    held, n_held = [], 0
    for batch in batches:
        held.append(batch)
        n_held += batch.num_rows
        if n_held < TASK_CELLS:
            continue
        rows = pa.Table.from_batches(held)
        hashes = rows.column(_HASH).to_numpy()
        last = int(np.argmax(hashes == hashes[-1]))  # where the feature that may go on begins
        if last:
            yield rows.slice(0, last)
        held, n_held = rows.slice(last).to_batches(), n_held - last
    if n_held:
        yield pa.Table.from_batches(held)


def _codes(column: pa.ChunkedArray) -> np.ndarray:
    """Equal numbers for equal values."""
    return column.combine_chunks().dictionary_encode().indices.to_numpy().astype(np.int64)


def _of_groups(groups: np.ndarray, values: np.ndarray, probs: Sequence[float]) -> tuple[np.ndarray, ...]:
    """For each row its group's size and quantiles, as `quantiles.py` takes them, and where the group begins.
    Rows come ordered by group and value."""
    begins = np.flatnonzero(np.diff(groups, prepend=groups[0] - 1))
    sizes = np.diff(begins, append=len(groups))
    found = []
    for prob in probs:
        exact = prob * (sizes - 1).astype(np.float64)
        low, high = values[begins + np.floor(exact).astype(np.int64)], values[begins + np.ceil(exact).astype(np.int64)]
        found.append(np.where(low == high, low, (np.ceil(exact) - exact) * low + (exact - np.floor(exact)) * high))
    return *(np.repeat(x, sizes) for x in (sizes, *found)), begins


def _z(groups: np.ndarray, values: np.ndarray) -> pa.Array:
    """`robust_z` of each value in its group. Values come ordered within each group, groups in any order."""
    order = np.argsort(groups, kind="stable")
    v = values[order]
    n, q1, median, q3, _ = _of_groups(groups[order], v, QUARTILES)
    spread = q3 - q1
    unit = spread / names.IQR_TO_SIGMA
    none = (n < 2) | ((unit == 0) & (spread != 0))
    z, missing = np.empty(len(v)), np.empty(len(v), bool)
    z[order] = np.where(spread == 0, 0.0, (v - median) / np.where(unit == 0, 1.0, unit))
    missing[order] = none
    return pa.array(z, mask=missing, from_pandas=False)


def _scorer(keys: Sequence[str], lower: float, upper: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_features(batches):
            feature, values = _codes(rows.column(NAME)), rows.column(VALUE).to_numpy()
            order = np.lexsort((values, feature))
            feature, values = feature[order], values[order]
            _, low, median, high, begins = _of_groups(feature, values, (lower, 0.5, upper))
            values = np.maximum(np.minimum(values, high), low)
            base = np.zeros(len(values))
            base[begins] = median[begins] ** 2
            with np.errstate(all="ignore"):  # as in Spark, numbers may pass all bounds
                by = [(c := _codes(rows.column(k))[order]) + feature * (c.max() + 1) for k in keys]
                z = [_z(groups, values) for groups in by]
            # In order of the values, which are ordered within every group.
            rows = rows.select([*keys, NAME]).take(pa.array(order)).combine_chunks()
            yield from pa.Table.from_arrays(
                [*rows.columns, pa.array(values), *z, pa.array(median), pa.array(base)],
                [*keys, NAME, VALUE, *(of(VALUE) for of in (names.self_z, names.peer_z)), "median", _BASE]).to_batches()

    return scored


def scored_cells(
    cells: DataFrame, entity: str = names.ENTITY, period: str = names.PERIOD, lower: float = names.WINSOR_LOWER,
    upper: float = names.WINSOR_UPPER, limit: int = GROUP_CELLS,
) -> tuple[DataFrame, float]:
    """Present cells (entity, period, feature, value) with limited values, the scores of each within its entity's
    and its period's cells of the feature, and the feature's `median`.

    The squares of the medians are in ``__base``, each at one cell of its feature; those of features with more
    than ``limit`` cells are the number that is returned beside the table.
    """
    keys = [entity, period]
    few, many = split_by_size(cells, limit)
    out = [*keys, NAME, VALUE, names.self_z(VALUE), names.peer_z(VALUE), "median", _BASE]
    kinds = {f.name: f.dataType for f in cells.schema.fields}
    schema = T.StructType([T.StructField(c, kinds.get(c, T.DoubleType())) for c in out])
    scored = few.select(*[col(c) for c in (*keys, NAME, VALUE)], F.xxhash64(col(NAME)).alias(_HASH)) \
        .repartition(_HASH).sortWithinPartitions(_HASH).mapInArrow(_scorer(keys, lower, upper), schema)
    if many is None:
        return scored, 0.0
    limited = materialize(limited_cells(many, keys, lower, upper, limit), "limited-cells")
    groups = groupings_quantiles(limited, [[entity, NAME], [period, NAME]], [VALUE], QUARTILES, limit)
    hot = attach_zscores(limited, list(zip(groups, (names.self_z, names.peer_z))), [VALUE])
    base = limited.groupBy(NAME).agg(F.first("median").alias("median")).agg(
        F.coalesce(F.sum(F.col("median") * F.col("median")), F.lit(0.0))).first()[0]
    return scored.unionByName(hot.withColumn(_BASE, F.lit(0.0)).select(*[col(c) for c in out])), base


def score_cells(
    filings: DataFrame, cells: DataFrame, *, entity: str = names.ENTITY, period: str = names.PERIOD,
    n_drivers: int = names.N_DRIVERS, limit: int = GROUP_CELLS, strangers: bool = True,
) -> DataFrame:
    """One scored row per filing (entity, period) from cells of any number of features.

    ``filings`` has unique keys, ``cells`` at most one row per filing and feature; cells of other filings are
    left out, which needs no join where there can be no such ``strangers``. Filings without a cell stay, with
    missing summaries.
    """
    keys = [entity, period]
    filings = filings.select(*[col(k) for k in keys])
    own = cells.select(*[col(k) for k in keys], col(NAME), finite(col(VALUE)).alias(VALUE)).where(
        F.col(VALUE).isNotNull() & col(NAME).isNotNull() & all_present(keys))
    if strangers:
        own = own.join(filings, keys, "left_semi")
    scored, base = scored_cells(materialize(own, "own-cells"), entity, period, limit=limit)
    scored = scored.withColumn("z", blend(col(names.self_z(VALUE)), col(names.peer_z(VALUE))))

    # A filing's cells, which are no more than its document holds, meet once for the sums and the drivers.
    place = F.row_number().over(Window.partitionBy(*[col(k) for k in keys]).orderBy(
        F.round(F.abs(F.col("z")), 9).desc(), F.col(NAME)))  # scores equal but for rounding go by name
    summed = scored.withColumn("place", F.when(F.col("z").isNotNull(), place)).groupBy(*[col(k) for k in keys]).agg(
        F.count("z").cast("int").alias("num_features_used"),
        *[F.avg(F.abs(col(c))).alias(name) for c, name in (
            (names.self_z(VALUE), "self_history_score"), (names.peer_z(VALUE), "peer_relative_score"),
            ("z", "combined_signal_strength"))],
        F.sum(F.col(VALUE) * F.col(VALUE) - F.col("median") * F.col("median")).alias("__more"),
        F.sum(_BASE).alias(_BASE), *[
            F.max(F.when(F.col("place") == i, F.col(c))).alias(f"top_driver_{i}{suffix}")
            for i in range(1, n_drivers + 1) for c, suffix in ((NAME, ""), ("z", "_value"))])
    summed = materialize(summed, "filing-sums")
    base += summed.agg(F.coalesce(F.sum(_BASE), F.lit(0.0))).first()[0]
    measured = filings.join(summed.drop(_BASE), keys, "left").withColumn(
        "num_features_used", F.coalesce("num_features_used", F.lit(0))).withColumn(
        "mahalanobis_distance", F.lit(float(base)) + F.coalesce("__more", F.lit(0.0))).drop("__more")
    return percentile_scores(measured)
