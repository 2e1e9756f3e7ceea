"""Robust anomaly scoring of company-by-period panels on Spark DataFrames."""

from plumbline.operators.dedup import feature_profile, first_per_key, numeric_features
from plumbline.operators.drivers import summary_scores, top_drivers, with_driver_summary
from plumbline.operators.listed import listed_rows
from plumbline.operators.mcd import robust_mahalanobis
from plumbline.operators.quality import m_score
from plumbline.operators.quantiles import column_quantiles, group_quantiles
from plumbline.operators.ranking import ordered_scores, percentile_scores, preview, top_n
from plumbline.operators.winsor import impute_medians, squared_norm, winsorize
from plumbline.operators.zscores import (
    combine_zscores, peer_zscores, sector_peer_zscores, self_and_peer_zscores,
    self_history_zscores,
)
from plumbline.plans.flatten import flatten_bundle_folder, flatten_bundle_packs, flatten_filings_table
from plumbline.plans.review import build_review_pack
from plumbline.plans.scoring import score_filings, score_wide_map, score_with_counts
from plumbline.plans.synthesis import (
    company_trend, conviction_scores, eligible, filing_intelligence, join_explanations,
    join_narrative, save_trend, tiered_pack,
)
from plumbline.sinks.outputs import publish_output, publish_outputs, publish_set, read_published, write_csv
from plumbline.sources.bundles import load_bundles, load_packs, pack_folder, save_packs
from plumbline.sources.records import read_records
from plumbline.sources.tables import (
    discover_features, filings_of_quarters, load_filings_table, save_filings_table,
)

__all__ = [name for name in dir() if not name.startswith("_")]
