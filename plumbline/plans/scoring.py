"""The scoring job: features in, one scored row per entity and period out."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from plumbline import names
from plumbline.functions.expressions import col
from plumbline.operators.dedup import first_per_key, numeric_features
from plumbline.operators.drivers import summary_scores, top_drivers
from plumbline.operators.groups import GROUP_CELLS, fits_broadcast
from plumbline.operators.mcd import robust_distance, with_filled
from plumbline.operators.quantiles import column_quantiles
from plumbline.operators.ranking import ordered_scores, percentile_scores
from plumbline.operators.sparse import score_cells
from plumbline.operators.winsor import apply_bounds, squared_norm
from plumbline.operators.zscores import combine_zscores, self_and_peer_zscores
from plumbline.session import materialize
from plumbline.sources.bundles import FlatFilings

DISTANCES = ("mcd", "l2")


@dataclass(frozen=True)
class ScoredFilings:
    """Scores, and what the job saw on the way: rows read, duplicates dropped, filings scored, features
    given, and features that have a value anywhere."""

    table: DataFrame
    counts: dict[str, int]


def score_filings(features_df: DataFrame, features: Sequence[str], **options) -> DataFrame:
    """The table of `score_with_counts`."""
    return score_with_counts(features_df, features, **options).table


def score_with_counts(
    features_df: DataFrame, features: Sequence[str], *, n_drivers: int = names.N_DRIVERS,
    listing_order: Sequence[Column] = (), distance: str = "mcd",
    support_fraction: float = names.SUPPORT_FRACTION, random_state: int = names.SEED,
    peer_keys: Sequence[str] = (names.PERIOD,), scored_at: datetime | None = None,
    cells: int = GROUP_CELLS, ordered: bool = True,
) -> ScoredFilings:
    """Score every filing; see `names` for the fixed settings.

    The counts are observed while the deduplicated table is written, not in a pass of their own.
    The deduplicated features are written once and every later pass scans only the columns it needs.
    Distance and percentile come first, while rows are narrow; the z-scores widen the row threefold
    and come after the last shuffle they do not need.
    """
    if distance not in DISTANCES:
        raise ValueError(f"distance must be one of {DISTANCES}")
    features = list(features)
    started = scored_at or datetime.now(timezone.utc)
    seen, kept = Observation(), Observation()
    read = features_df.observe(seen, F.count(F.lit(1)).alias("rows"))
    unique = numeric_features(first_per_key(read, order=listing_order), features) \
        .observe(kept, F.count(F.lit(1)).alias("rows"))
    carried = [c for c in dict.fromkeys([*names.IDENTITY, *peer_keys, *features]) if c in unique.columns]
    panel = materialize(unique.select(*[col(c) for c in carried]), "panel")

    # Limits and medians in one measurement: limiting a feature does not move its median.
    rows_read, n_rows = seen.get["rows"], kept.get["rows"]
    found = column_quantiles(
        panel, features, [names.WINSOR_LOWER, 0.5, names.WINSOR_UPPER], cells, n_rows=n_rows)
    counts = {"rows_read": rows_read, "duplicates_dropped": rows_read - n_rows, "filings_scored": n_rows,
              "features": len(features), "features_with_values": sum(n > 0 for n, _ in found.values())}
    ranges = {f: tuple(q) if n else None for f, (n, q) in found.items()}
    medians = {f: r and r[1] for f, r in ranges.items()}
    limited = apply_bounds(panel, {f: r and (r[0], r[2]) for f, r in ranges.items()})
    # Clipped features, and filled ones for the fit, in one table.
    staged = materialize(with_filled(limited, medians) if distance == "mcd" else limited, "clipped")
    clipped = staged.select(*[col(c) for c in panel.columns])
    if distance == "mcd":
        measured = robust_distance(
            staged, ranges, support_fraction, random_state, cells=cells)
    else:
        measured = squared_norm(clipped, features, medians=medians)
    ranked = percentile_scores(measured)
    scored = combine_zscores(
        self_and_peer_zscores(ranked, features, names.ENTITY, peer_keys, cells, measure=clipped),
        features)
    finished = top_drivers(summary_scores(scored, features), features, n_drivers)
    out = finished.select(*score_columns(
        finished, features, n_drivers, started,
        names.MODEL_TYPE if distance == "mcd" else names.MODEL_TYPE_L2))
    # A global sort looks at its input twice, so that is written first.
    return ScoredFilings(ordered_scores(materialize(out, "scored")) if ordered else out, counts)


def score_wide_map(flat: FlatFilings, **options) -> DataFrame:
    """Scores of filings whose features are rows (`FlatFilings.cells`), of any number of features.

    One filing per entity and period, as in `score_filings`; the distance is the plain one. Options are
    those of `sparse.score_cells`.
    """
    filings = materialize(first_per_key(flat.table), "wide-filings")
    cells = flat.cells.where(F.col("source_path").isNotNull())
    if flat.table.count() > filings.count():
        # Documents that gave way to others of their key are few, as a rule.
        gone = materialize(flat.table.select("source_path").join(
            filings.select("source_path"), "source_path", "left_anti").distinct(), "other-documents")
        cells = cells.join(F.broadcast(gone), "source_path", "left_anti") if fits_broadcast(gone.count(), 160) \
            else cells.join(filings.select("source_path"), "source_path", "left_semi")
    # Every key of the table has its filing.
    scored = score_cells(filings, cells, strangers=False, **options)
    identity = [c for c in names.IDENTITY if c in filings.columns]
    return filings.select(*[col(c) for c in identity]).join(scored, [names.ENTITY, names.PERIOD])


def score_columns(
    df: DataFrame, features: Sequence[str], n_drivers: int, scored_at: datetime,
    model_type: str = names.MODEL_TYPE,
) -> list[Column]:
    """The score table, in order; company name and CIK default to empty text when absent."""
    identity = [
        col(c) if c in df.columns else F.lit("" if c in ("company_name", "cik") else None)
        .cast("string").alias(c) for c in names.IDENTITY]
    drivers = [c for i in range(1, n_drivers + 1)
               for c in (f"top_driver_{i}", f"top_driver_{i}_value")]
    z_scores = [of(f) for of in (names.self_z, names.peer_z, names.combined_z) for f in features]
    return [
        *identity, *[col(c) for c in names.SCORES + drivers],
        F.lit(model_type).alias("model_type"), *[col(c) for c in z_scores],
        F.lit(names.SCORING_VERSION).alias("scoring_version"),
        F.lit(scored_at).cast("timestamp").alias("scored_at"),
    ]
