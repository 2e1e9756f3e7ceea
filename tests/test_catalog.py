"""Registered queries against their SQL on the smallest tables."""

import os

import pytest

from plumbline.catalog.oracle import ORACLE
from plumbline.catalog.queries import QUERIES
from tests.compare import compare, oracle_connection

SF = "/root/testdata/sf0.001"
ROWS_ONLY = {"mcd_distance", "embedding_distance", "score_filings"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF)


def test_every_query_has_sql_or_is_known_not_to():
    assert set(QUERIES) - set(ORACLE) == ROWS_ONLY
    assert set(ORACLE) <= set(QUERIES)


# Queries whose SQL the other tests do not already cover by brute force.
@pytest.mark.parametrize("name", [
    "scan_form_filter", "dedup_panel", "feature_profile", "safe_names", "winsorize_hot",
    "mcd_full_support", "review_pack", "bundle_scan", "json_flatten", "driver_summary", "m_score",
    "company_trend", "percentile_score_ranges", "score_filings_l2",
])
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], ORACLE[name], SF) == ""


def test_entry(spark):
    import __spark_entry__ as contract
    df = contract.entry(spark)
    assert df.count() > 0 and "anomaly_score_0_100" in df.columns
    assert contract.queries().keys() >= contract.oracle_sql().keys()
