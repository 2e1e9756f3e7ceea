"""Column names and fixed values shared by every stage."""

from __future__ import annotations

# --- fixed values: these must equal the scored tables users already have -------------------------
ENTITY = "ticker"
PERIOD = "report_date"

# Keys of the free-form feature object that are bookkeeping, not features.
BUNDLE_BOOKKEEPING = [
    "target_year", "target_period_end", "target_form", "years_covered", "feature_count",
]

# Columns of a flat table that are never features, whatever their type.
NOT_FEATURES = [
    "ticker", "company_name", "cik", "form_type", "year", "feature_count",
    "report_date", "filing_date", "accession_number", "filing_url",
]

BUNDLE_SUFFIX = "_analysis_ready.json"
DEFAULT_FORM = "10-Q"

Z_CLIP = 8.0
WINSOR_LOWER, WINSOR_UPPER = 0.05, 0.95
IQR_TO_SIGMA = 1.35
SUPPORT_FRACTION = 0.75
SEED = 42
N_DRIVERS = 3
TOP_N = 20

MODEL_TYPE = "robust_mcd"
SCORING_VERSION = "brick3_q_v2_robust_mahalanobis_clipped"

SCORES_TABLE = "quarterly_scores_detailed"
REVIEW_TABLE = "top_anomaly_review_pack"

PATTERNS = [
    "Earnings Quality Risk", "Growth Bubble", "Financial Distress",
    "Aggressive Asset Expansion", "Recovery", "M&A Distortion", "Idiosyncratic",
]
NARRATIVE_LABELS = ["CONTRADICTS", "CORROBORATES", "NEUTRAL"]
TIER_FLOORS = {"ALERT": 65.0, "FLAG": 40.0, "WATCH": 20.0}
MANIPULATOR_CUTOFF = -2.22
# Columns of the score table that identify a filing, and the score columns after them, in order.
IDENTITY = ["ticker", "company_name", "cik", "form_type", "report_date", "filing_date", "filing_url"]
SCORES = [
    "anomaly_score_0_100", "mahalanobis_distance", "self_history_score", "peer_relative_score",
    "combined_signal_strength", "num_features_used",
]
# Columns of the review pack before its raw features, in order.
PACK = [
    "ticker", "company_name", "report_date", "filing_date", "filing_url",
    "anomaly_score_0_100", "mahalanobis_distance", "self_history_score", "peer_relative_score",
    "combined_signal_strength", "num_features_used",
    "top_driver_1", "top_driver_1_value", "top_driver_2", "top_driver_2_value",
    "top_driver_3", "top_driver_3_value", "driver_summary",
]
# Words of a driver's label: side of the baseline, and what is put before it at the clip.
ABOVE, BELOW, FAR, BASELINE = "above", "below", "far ", " baseline ("
# Characters of a column name that are replaced, and the prefix before a leading digit.
UNSAFE, DIGIT_PREFIX = "[^a-z0-9_]", "f_"
# --- end of fixed values -------------------------------------------------------------------------


# Model type of the sum-of-squares distance, a choice of this project.
MODEL_TYPE_L2 = "sum_of_squares"


def self_z(feature: str) -> str:
    return f"self_z__{feature}"


def peer_z(feature: str) -> str:
    return f"peer_z__{feature}"


def combined_z(feature: str) -> str:
    return f"combined_z__{feature}"
