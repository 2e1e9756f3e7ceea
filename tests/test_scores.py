import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import plumbline as pl
from plumbline import names
from plumbline.operators import groups, ranking
from plumbline.plans import scoring

FEATURES = ["f1", "f2"]


def frame(spark, rows, schema="ticker string, report_date string, f1 double, f2 double"):
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def panel(spark):
    rng = np.random.default_rng(5)
    rows = []
    for t in range(12):
        for q in range(9):
            rows.append((f"T{t}", f"2024-{q + 1:02d}-01", float(rng.normal()),
                         None if rng.random() < 0.2 else float(rng.integers(0, 4))))
    rows += [("LONE", "2024-01-01", 1.0, 2.0), (None, "2024-02-01", 3.0, 1.0),
             ("T1", None, 9.0, 1.0)]
    return frame(spark, rows)


def brute_z(pdf, by, feature):
    out = pd.Series(np.nan, index=pdf.index)
    for _, idx in pdf.groupby(by).groups.items():
        x = pdf.loc[idx, feature]
        known = x.dropna()
        if len(known) < 2:
            continue
        q1, med, q3 = known.quantile([0.25, 0.5, 0.75])
        out[idx] = 0.0 if q3 == q1 else (x - med) / ((q3 - q1) / 1.35)
    return out


@pytest.mark.parametrize("cells", [groups.GROUP_CELLS, 6])
def test_self_and_peer_z_equal_brute_force(spark, panel, cells):
    got = pl.self_and_peer_zscores(panel, FEATURES, cells=cells).toPandas()
    for f in FEATURES:
        np.testing.assert_allclose(
            got[names.self_z(f)].astype(float), brute_z(got, "ticker", f), atol=1e-9)
        np.testing.assert_allclose(
            got[names.peer_z(f)].astype(float), brute_z(got, "report_date", f), atol=1e-9)
    lone = got[got.ticker == "LONE"].iloc[0]
    assert np.isnan(lone[names.self_z("f1")]) and not np.isnan(lone[names.peer_z("f1")])
    assert got[got.ticker.isna()][names.self_z("f1")].isna().all()


def test_separate_functions_agree_with_the_joint_one(spark, panel):
    both = pl.self_and_peer_zscores(panel, FEATURES)
    apart = pl.peer_zscores(pl.self_history_zscores(panel, FEATURES), FEATURES)
    assert both.columns == apart.columns
    assert both.exceptAll(apart).count() == 0


def test_sector_peers_without_sector_get_none(spark, panel):
    sectors = spark.createDataFrame([(f"T{i}", "A" if i % 2 else "B") for i in range(10)],
                                    "ticker string, sector string")
    got = pl.sector_peer_zscores(panel, FEATURES, sectors)
    assert got.where("sector IS NULL AND peer_z__f1 IS NOT NULL").count() == 0
    assert got.where("ticker = 'T1' AND report_date IS NOT NULL").select(
        "calendar_quarter").distinct().count() == 3


def test_winsorize_and_impute_keep_the_missing_rules(spark):
    df = frame(spark, [("a", "d", float(i), None) for i in range(101)])
    got = pl.winsorize(df, FEATURES).toPandas()
    assert got.f1.min() == 5.0 and got.f1.max() == 95.0 and got.f2.isna().all()
    holes = frame(spark, [("a", "d", 1.0, 1.0), ("b", "d", None, 3.0), ("c", "d", 5.0, None)])
    filled = pl.impute_medians(holes, FEATURES).toPandas()
    assert filled.f1.tolist() == [1.0, 3.0, 5.0] and filled.f2.tolist() == [1.0, 3.0, 2.0]


def test_nan_and_infinity_are_missing_at_every_operator(spark):
    nan, inf = float("nan"), float("inf")
    rows = [("a", "d", nan, 1.0), ("b", "d", inf, 2.0), ("c", "d", 1.0, 3.0), ("e", "d", 2.0, 4.0), ("f", "d", 3.0, nan)]
    df = frame(spark, rows)
    clean = frame(spark, [tuple(None if v in (inf,) or v != v else v for v in r) for r in rows])
    same = lambda one, other: sorted(map(repr, one.collect())) == sorted(map(repr, other.collect()))
    assert same(pl.winsorize(df, FEATURES), pl.winsorize(clean, FEATURES))
    assert same(pl.impute_medians(df, FEATURES), pl.impute_medians(clean, FEATURES))
    assert same(pl.peer_zscores(df, FEATURES).drop(*FEATURES), pl.peer_zscores(clean, FEATURES).drop(*FEATURES))
    assert same(pl.percentile_scores(df, "f1", "s").select("ticker", "s"),
                pl.percentile_scores(clean, "f1", "s").select("ticker", "s"))
    assert same(pl.robust_mahalanobis(df, FEATURES).drop(*FEATURES), pl.robust_mahalanobis(clean, FEATURES).drop(*FEATURES))


def test_the_plain_distance_fills_holes_and_names_itself(spark):
    df = frame(spark, [("a", "d1", None, 1.0), ("b", "d1", 2.0, None), ("c", "d1", 4.0, 3.0)])
    rows = pl.score_filings(df, FEATURES, distance="l2").collect()
    assert all(r["mahalanobis_distance"] is not None and r["anomaly_score_0_100"] is not None for r in rows)
    assert {r["model_type"] for r in rows} == {"sum_of_squares"}


def test_percentile_scores_share_ties(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (2.0,), (5.0,), (5.0,), (None,)], "x double")
    got = pl.percentile_scores(df, "x", "s").orderBy(F.col("x").asc_nulls_last()).collect()
    assert [r["s"] for r in got] == [20.0, 50.0, 50.0, 90.0, 90.0, None]


@pytest.mark.parametrize("options", [
    {}, {"range_values": 7}, {"range_values": 7, "row_bytes": 1 << 22,
                                    "hot_value_rows": 50}])
def test_percentile_scores_every_path(spark, options):
    """Few and many ranges, and the shuffle join with a value held by a third of the rows."""
    rng = np.random.default_rng(2)
    x = np.where(rng.random(900) < 1 / 3, 3.0, rng.integers(0, 60, 900)).astype(float)
    x[:20] = np.nan
    pdf = pd.DataFrame({"id": range(900), "x": x})
    df = spark.createDataFrame(
        [(i, None if v != v else v) for i, v in pdf.itertuples(index=False)], "id int, x double")
    got = pl.percentile_scores(df.repartition(4), "x", "s", **options).toPandas().sort_values("id")
    np.testing.assert_allclose(
        got.s.to_numpy(float), (pdf.x.rank(pct=True) * 100).round(4).to_numpy())


def test_dedup_treats_missing_keys_as_equal_and_keeps_the_first(spark):
    df = frame(spark, [("a", "d", 1.0, 0.0), ("a", "d", 2.0, 1.0), (None, "d", 3.0, 2.0),
                       (None, "d", 4.0, 3.0), ("a", None, 5.0, 4.0)])
    got = pl.first_per_key(df, order=[F.col("f2")]).select("f1").collect()
    assert sorted(r[0] for r in got) == [1.0, 3.0, 5.0]


def test_profile_counts_copies_and_entities(spark):
    df = frame(spark, [("a", "d", 1.0, 0.0), ("a", "d", 2.0, 1.0), ("b", "d", 2.0, 1.0),
                       (None, "d", 2.0, 1.0)])
    assert tuple(pl.feature_profile(df, FEATURES).first()) == (4, 2, 1, 2)


def test_summary_and_drivers_without_any_score(spark):
    df = frame(spark, [("a", "d", 1.0, None)])
    scored = pl.combine_zscores(pl.self_and_peer_zscores(df, FEATURES), FEATURES)
    row = pl.top_drivers(pl.summary_scores(scored, FEATURES), FEATURES, 3).first()
    assert row["num_features_used"] == 0 and row["combined_signal_strength"] is None
    assert [row[f"top_driver_{i}"] for i in (1, 2, 3)] == [None] * 3
    assert pl.with_driver_summary(spark.createDataFrame([row], schema=pl.top_drivers(
        pl.summary_scores(scored, FEATURES), FEATURES, 3).schema)).first()["driver_summary"] == ""


def test_score_table_shape_and_rules(spark, panel):
    extra = panel.unionAll(panel.limit(7)).select(
        "*", F.lit("10-Q").alias("form_type"), F.lit("2024-09-09").alias("filing_date"),
        F.lit("u").alias("filing_url"), F.lit("x").alias("accession_number"))
    out = pl.score_filings(extra, FEATURES)
    assert out.columns == [
        "ticker", "company_name", "cik", "form_type", "report_date", "filing_date", "filing_url",
        "anomaly_score_0_100", "mahalanobis_distance", "self_history_score", "peer_relative_score",
        "combined_signal_strength", "num_features_used", "top_driver_1", "top_driver_1_value",
        "top_driver_2", "top_driver_2_value", "top_driver_3", "top_driver_3_value", "model_type",
        "self_z__f1", "self_z__f2", "peer_z__f1", "peer_z__f2", "combined_z__f1", "combined_z__f2",
        "scoring_version", "scored_at"]
    rows = out.collect()
    assert len(rows) == panel.count()
    scores = [r["anomaly_score_0_100"] for r in rows]
    assert scores == sorted(scores, reverse=True) and scores[0] <= 100
    assert {r["company_name"] for r in rows} == {""} and {r["cik"] for r in rows} == {""}
    assert len({r["scored_at"] for r in rows}) == 1
    assert all(r["top_driver_3"] is None for r in rows)  # two features fill two slots


def test_hot_groups_do_not_change_the_scores(spark, panel):
    usual = pl.score_filings(panel, FEATURES, distance="l2").drop("scored_at").toPandas()
    hot = pl.score_filings(panel, FEATURES, distance="l2", cells=6).drop("scored_at").toPandas()
    pd.testing.assert_frame_equal(usual, hot, rtol=1e-9)


def test_unknown_distance_is_refused(spark, panel):
    with pytest.raises(ValueError):
        scoring.score_filings(panel, FEATURES, distance="nope")


def test_top_n_orders_ties_by_key_and_missing_last(spark):
    df = spark.createDataFrame(
        [("b", "1", 5.0), ("a", "2", 5.0), ("a", "1", 5.0), ("c", "1", None), ("d", "1", 9.0)],
        "ticker string, report_date string, anomaly_score_0_100 double")
    got = [(r[0], r[1]) for r in pl.top_n(df, 4).collect()]
    assert got == [("d", "1"), ("a", "1"), ("a", "2"), ("b", "1")]
    assert pl.ordered_scores(df).collect()[-1]["ticker"] == "c"
