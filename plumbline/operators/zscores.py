"""Robust z-scores against the entity's own history and against its peers."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline import names
from plumbline.functions.expressions import blend, calendar_quarter, col, finite, robust_z
from plumbline.operators.groups import GROUP_CELLS, attach_small
from plumbline.operators.quantiles import (
    GroupStats, attach_group_stats, group_quantiles, groupings_quantiles, n_col, q_col,
)

QUARTILES = (0.25, 0.5, 0.75)


def quartile_stats(
    df: DataFrame, by: Sequence[str], features: Sequence[str], cells: int = GROUP_CELLS,
) -> GroupStats:
    """Counts and quartiles per group, one aggregate for all features."""
    return group_quantiles(df, by, features, QUARTILES, cells)


def attach_zscores(
    df: DataFrame, scores: Sequence[tuple[GroupStats, Callable[[str], str]]],
    features: Sequence[str],
) -> DataFrame:
    """Add one robust z-score column per feature and grouping, one join per grouping.

    The statistics come first and are separate from ``df``, so measuring one grouping never repeats
    the joins of another. Rows without a group key get no score.
    """
    out, added = df, []
    for i, (stats, name) in enumerate(scores):
        joined = attach_group_stats(out, stats)
        fresh = {name(f): robust_z(finite(col(f)), col(n_col(f)), col(q_col(f)))
                 for f in features}
        out = joined.select(
            *[col(c) for c in df.columns], *[col(c) for c in added],
            *[z.alias(c) for c, z in fresh.items()])
        added += list(fresh)
    return out


def self_history_zscores(
    df: DataFrame, features: Sequence[str], entity: str = names.ENTITY, cells: int = GROUP_CELLS,
) -> DataFrame:
    """Add `self_z__*`: each row against the whole history of its entity, later periods included."""
    stats = quartile_stats(df, [entity], features, cells)
    return attach_zscores(df, [(stats, names.self_z)], features)


def peer_zscores(
    df: DataFrame, features: Sequence[str], peer_keys: Sequence[str] = (names.PERIOD,),
    cells: int = GROUP_CELLS,
) -> DataFrame:
    """Add `peer_z__*`: each row against all rows sharing its peer keys, itself included."""
    stats = quartile_stats(df, peer_keys, features, cells)
    return attach_zscores(df, [(stats, names.peer_z)], features)


def self_and_peer_zscores(
    df: DataFrame, features: Sequence[str], entity: str = names.ENTITY,
    peer_keys: Sequence[str] = (names.PERIOD,), cells: int = GROUP_CELLS,
    measure: DataFrame | None = None,
) -> DataFrame:
    """Add both `self_z__*` and `peer_z__*`; both groupings are measured in one pass.

    ``measure`` is a cheaper table with the same keys and features to take the statistics from, for
    when ``df`` already carries joins that the statistics do not need.
    """
    source = df if measure is None else measure
    own, peers = groupings_quantiles(source, [[entity], peer_keys], features, QUARTILES, cells)
    return attach_zscores(df, [(own, names.self_z), (peers, names.peer_z)], features)


def sector_peer_zscores(
    df: DataFrame, features: Sequence[str], sectors: DataFrame, entity: str = names.ENTITY,
    period: str = names.PERIOD, cells: int = GROUP_CELLS,
) -> DataFrame:
    """Add `sector`, `calendar_quarter` and `peer_z__*` within the two.

    ``sectors`` maps entity to sector, one row per entity. Entities without a sector get no peer
    score, so a later blend uses their own history alone.
    """
    mapping = sectors.select(col(entity), F.col("sector"))
    known = attach_small(df, mapping, [entity], mapping.count(), 64).select(
        *[col(c) for c in df.columns], F.col("sector"),
        calendar_quarter(col(period)).alias("calendar_quarter"))
    return peer_zscores(known, features, ["sector", "calendar_quarter"], cells)


def combine_zscores(
    df: DataFrame, features: Sequence[str], limit: float = names.Z_CLIP,
) -> DataFrame:
    """Add `combined_z__*` from the self and peer scores of the same row."""
    return df.select("*", *[
        blend(col(names.self_z(f)), col(names.peer_z(f)), limit).alias(names.combined_z(f))
        for f in features])
