import pytest
from pyspark.sql import functions as F

import plumbline as pl
from plumbline import names
from plumbline.operators.quality import ACCOUNT_COLUMNS, M_WEIGHTS
from plumbline.plans.review import select_present
from plumbline.plans.synthesis import join_labels, outside_domain, tier_of

SCORES = ("ticker string, report_date string, filing_date string, anomaly_score_0_100 double, "
          "top_driver_1 string, top_driver_1_value double")


@pytest.fixture(scope="module")
def scores(spark):
    return spark.createDataFrame([
        ("A", "2024-03-31", "2024-05-01", 99.0, "f1", 8.0),
        ("B", "2024-03-31", "2024-05-01", 50.0, "f1", -0.0005),
        (None, "2024-03-31", None, 97.0, None, None),
        ("C", "2024-06-30", "2024-08-01", 10.0, "f1", 1.5),
        ("D", "2024-06-30", "2024-08-01", None, "f1", 1.0)], SCORES)


def test_review_pack_joins_first_raw_copy_and_missing_keys(spark, scores):
    raw = spark.createDataFrame([
        ("A", "2024-03-31", 1, 1.0), ("A", "2024-03-31", 2, 9.0), (None, "2024-03-31", 3, 7.0),
        ("C", "2024-06-30", 4, 4.0), ("Z", "2024-06-30", 5, 5.0)],
        "ticker string, report_date string, pos int, f1 double")
    pack = pl.build_review_pack(scores, raw, ["f1"], 3, [F.col("pos")]).collect()
    assert [(r["ticker"], r["f1"]) for r in pack] == [("A", 1.0), (None, 7.0), ("B", None)]
    assert [r["driver_summary"] for r in pack] == [
        "f1: far above baseline (8.0)", "", "f1: below baseline (-0.0005)"]
    assert "company_name" not in pack[0].asDict()


def test_pack_for_more_rows_than_may_be_broadcast(spark, scores, monkeypatch):
    from plumbline.operators import groups
    raw = spark.createDataFrame([("A", "2024-03-31", 1.0), ("C", "2024-06-30", 4.0)],
                                "ticker string, report_date string, f1 double")
    small = pl.build_review_pack(scores, raw, ["f1"], 5).collect()
    monkeypatch.setattr(groups, "BROADCAST_BYTES", 0)
    assert pl.build_review_pack(scores, raw, ["f1"], 5).collect() == small


def test_select_present_skips_what_is_not_there(scores):
    assert select_present(scores, ["nope", "ticker", "filing_date"]).columns == ["ticker", "filing_date"]


def test_preview_is_five_rows_of_five_columns(scores):
    shown = pl.preview(scores, 2)
    assert len(shown.columns) == 5 and [r["ticker"] for r in shown.collect()] == ["A", None]


def test_m_score_by_hand(spark):
    before = dict(zip(ACCOUNT_COLUMNS, [10, 100, 60, 30, 40, 5, 100, 4, 20, 10, 8, 15, 20]))
    after = dict(zip(ACCOUNT_COLUMNS, [18, 120, 75, 36, 44, 5, 110, 4, 26, 14, 6, 18, 25]))
    rows = [("A", "2023-03-31", *map(float, before.values())),
            ("A", "2024-03-31", *map(float, after.values()))]
    df = spark.createDataFrame(rows, "ticker string, report_date string, " + ", ".join(
        f"{c} double" for c in ACCOUNT_COLUMNS))
    first, last = pl.m_score(df.unionAll(df)).orderBy("report_date").collect()
    assert first["m_score"] is None and first["likely_manipulator"] is None
    ratios = {
        "dsri": (18 / 120) / (10 / 100), "gmi": (40 / 100) / (45 / 120),
        "aqi": (1 - 85 / 110) / (1 - 75 / 100), "sgi": 1.2, "depi": (4 / 44) / (4 / 48),
        "sgai": (26 / 120) / (20 / 100), "tata": (14 - 6) / 110, "lvgi": (43 / 110) / (35 / 100)}
    for name, value in ratios.items():
        assert last[name] == pytest.approx(value)
    expected = -4.84 + sum(M_WEIGHTS[n] * v for n, v in ratios.items())
    assert last["m_score"] == pytest.approx(expected)
    assert last["likely_manipulator"] == (expected > -2.22)


def test_m_score_with_a_zero_denominator_is_missing(spark):
    rows = [("A", d, *[0.0] * len(ACCOUNT_COLUMNS)) for d in ("2023-03-31", "2024-03-31")]
    df = spark.createDataFrame(rows, "ticker string, report_date string, " + ", ".join(
        f"{c} double" for c in ACCOUNT_COLUMNS))
    assert [r["m_score"] for r in pl.m_score(df).collect()] == [None, None]


@pytest.mark.parametrize("earlier, later", [
    ("2023-02-28", "2024-02-29"), ("2022-06-25", "2023-07-01"), ("2023-07-01", "2024-06-29"),
    ("2023-03-31", "2024-04-06"), ("2022-12-31", "2023-12-30")])
def test_m_score_finds_period_ends_that_drift(spark, earlier, later):
    rows = [("A", d, *[float(i + 2 + n) for i in range(len(ACCOUNT_COLUMNS))])
            for n, d in enumerate([earlier, later])] + [("A", "n/a", *[1.0] * len(ACCOUNT_COLUMNS))]
    df = spark.createDataFrame(rows, "ticker string, report_date string, " + ", ".join(
        f"{c} double" for c in ACCOUNT_COLUMNS))
    got = {r["report_date"]: r["sgi"] for r in pl.m_score(df).collect()}
    assert got == {earlier: None, later: pytest.approx(4 / 3), "n/a": None}


def test_top_n_takes_the_distance_among_equal_scores(spark):
    df = spark.createDataFrame([("A", "d", 100.0, 1.0), ("B", "d", 100.0, 3.0), ("C", "d", 100.0, None),
                                ("D", "d", None, 9.0), ("E", "d", 50.0, 7.0)],
                               "ticker string, report_date string, anomaly_score_0_100 double, "
                               "mahalanobis_distance double")
    assert [r["ticker"] for r in pl.top_n(df, 4).collect()] == ["B", "A", "C", "E"]


def test_a_bad_date_ends_no_job(spark, scores):
    bad = scores.withColumn("report_date", F.lit("n/a"))
    assert pl.company_trend(bad).where("calendar_quarter IS NULL").count() > 0


def test_tiers_are_half_open(spark):
    df = spark.createDataFrame([(s,) for s in (65.0, 64.9999, 40.0, 39.9999, 20.0, 19.9999, None)],
                               "s double")
    assert [r[0] for r in df.select(tier_of(F.col("s"))).collect()] == [
        "ALERT", "FLAG", "FLAG", "WATCH", "WATCH", None, None]


def test_labels_outside_the_domain_are_left_out_and_reported(spark, scores):
    labels = spark.createDataFrame([
        ("A", "2024-03-31", "CONTRADICTS", "p"), ("B", "2024-03-31", "MAYBE", "q"),
        ("C", "2024-06-30", None, "r")],
        "ticker string, report_date string, label string, passage string")
    joined = join_labels(scores, labels, "label", names.NARRATIVE_LABELS)
    assert joined.count() == scores.count()
    assert {(r["ticker"], r["label"]) for r in joined.collect() if r["label"]} == {("A", "CONTRADICTS")}
    assert outside_domain(labels, "label", names.NARRATIVE_LABELS).count() == 2


@pytest.fixture(scope="module")
def tables(spark):
    narrative = spark.createDataFrame(
        [("A", "2024-03-31", "CONTRADICTS", "why")],
        "ticker string, report_date string, label string, rationale string")
    briefs = spark.createDataFrame(
        [("A", "2024-03-31", "Recovery", "brief")],
        "ticker string, report_date string, pattern string, rationale string")
    quality = spark.createDataFrame(
        [("A", "2024-03-31", True), ("B", "2024-03-31", True)],
        "ticker string, report_date string, likely_manipulator boolean")
    return narrative, briefs, quality


def test_conviction_and_intelligence(spark, scores, tables):
    narrative, briefs, quality = tables
    known = scores.where("ticker IS NOT NULL")
    conviction = pl.conviction_scores(known, quality, narrative)
    got = {r["ticker"]: (r["conviction_score"], r["tier"]) for r in conviction.collect()}
    assert got == {"A": (99.6, "ALERT"), "B": (50.0, "FLAG"), "C": (4.0, None), "D": (0.0, None)}
    joined = pl.filing_intelligence(known, briefs, narrative, conviction, view="fi_test")
    assert spark.table("fi_test").count() == 4
    assert "narrative_rationale" in joined.columns and "rationale" in joined.columns
    pack = pl.tiered_pack(joined).collect()
    assert [r["ticker"] for r in pack] == ["A", "B"]


def test_trend_keeps_the_latest_filing_of_a_quarter(spark):
    df = spark.createDataFrame([
        ("A", "2024-03-31", "2024-05-01", 1), ("A", "2024-02-28", "2024-06-01", 2),
        ("A", "2024-06-30", "2024-08-01", 3), ("B", "2024-03-31", None, 4)],
        "ticker string, report_date string, filing_date string, v int")
    got = {(r["ticker"], r["calendar_quarter"]): r["v"] for r in pl.company_trend(df).collect()}
    assert got == {("A", "2024Q1"): 2, ("A", "2024Q2"): 3, ("B", "2024Q1"): 4}


def test_eligible(scores):
    assert pl.eligible(scores, "anomaly_score_0_100", 50.0).count() == 3
