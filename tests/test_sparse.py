"""Features as rows against the same scores from columns, and plan shapes of the saved trend."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import plumbline as pl
from plumbline.operators import groups
from plumbline.operators.sparse import score_cells
from plumbline.plans.synthesis import save_trend

FEATURES = [f"f{i}" for i in range(6)]


def panel(spark, seed=0):
    """Every filing has every feature but one; one feature does not vary."""
    rng = np.random.default_rng(seed)
    rows = [(f"T{t}", f"2024-{m:02d}", *[float(v) for v in rng.normal(size=4)], 2.0,
             None if (t + m) % 3 else float(rng.normal())) for t in range(12) for m in range(1, 9)]
    return spark.createDataFrame(rows, "ticker string, report_date string, " + ", ".join(f"{f} double" for f in FEATURES))


@pytest.mark.parametrize("limit", [500_000, 30])
def test_rows_score_like_columns(spark, limit):
    wide = panel(spark)
    cells = wide.unpivot(["ticker", "report_date"], FEATURES, "feature", "value")
    got = {tuple(r)[:2]: r for r in score_cells(wide, cells, limit=limit).collect()}
    limited = pl.winsorize(wide, FEATURES)
    scored = pl.combine_zscores(pl.self_and_peer_zscores(limited, FEATURES), FEATURES)
    filled = pl.impute_medians(limited, FEATURES)
    lengths = {tuple(r)[:2]: sum(v * v for v in r[2:]) for r in filled.collect()}
    assert len(got) == wide.count()
    for r in scored.collect():
        one = got[r["ticker"], r["report_date"]]
        # What the filing lacks has no row.
        zs = {f: r[f"combined_z__{f}"] for f in FEATURES if r[f] is not None and r[f"combined_z__{f}"] is not None}
        assert one["num_features_used"] == len(zs)
        assert one["combined_signal_strength"] == pytest.approx(np.mean([abs(z) for z in zs.values()]))
        top = sorted(zs, key=lambda f: (-abs(zs[f]), f))[:3]
        assert [one[f"top_driver_{i}"] for i in (1, 2, 3)] == top
        assert one["top_driver_1_value"] == pytest.approx(zs[top[0]])
        assert one["mahalanobis_distance"] == pytest.approx(lengths[r["ticker"], r["report_date"]])


def test_filings_without_cells_and_cells_without_filings(spark, monkeypatch):
    monkeypatch.setattr(groups, "BROADCAST_BYTES", 0)
    wide = panel(spark).limit(20)
    cells = wide.unpivot(["ticker", "report_date"], FEATURES, "feature", "value")
    filings = wide.select("ticker", "report_date").union(spark.createDataFrame([("T9", "none")], "a string, b string"))
    strange = spark.createDataFrame([("X", "2024-01", "f0", 1e9), ("T0", "2024-01", "f9", float("nan"))], cells.schema)
    got = {tuple(r)[:2]: r for r in score_cells(filings, cells.union(strange)).collect()}
    assert len(got) == 21 and ("X", "2024-01") not in got
    assert got["T9", "none"]["num_features_used"] == 0 and got["T9", "none"]["top_driver_1"] is None
    assert score_cells(filings.limit(0), cells).count() == 0


def test_a_saved_trend_is_joined_and_ranked_without_a_shuffle(spark, tmp_path):
    rows = [(f"T{t}", f"202{y}Q{q}", float(t * y + q)) for t in range(30) for y in range(3) for q in range(1, 5)]
    trend = spark.createDataFrame(rows, "ticker string, calendar_quarter string, score double")
    saved = save_trend(trend, "trend_of_the_test", str(tmp_path / "trend"), 4)
    other = save_trend(trend, "other_trend_of_the_test", str(tmp_path / "other"), 4)
    before = F.lag("score").over(Window.partitionBy("ticker").orderBy("calendar_quarter"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = saved.withColumn("before", before).join(
            other.groupBy("ticker").agg(F.max("score").alias("most")), "ticker")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        assert sorted(map(tuple, saved.select("ticker", "calendar_quarter", "score").collect())) == sorted(rows)
        assert joined.where(F.col("before").isNull()).count() == 30
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    pruned = saved.where(F.col("calendar_quarter") == "2021Q3")
    assert "PartitionFilters: [isnotnull(calendar_quarter" in pruned._jdf.queryExecution().executedPlan().toString()
    again = save_trend(trend.limit(5), "trend_of_the_test", str(tmp_path / "trend"), 4)
    assert again.count() == 5
    for name in ("trend_of_the_test", "other_trend_of_the_test"):
        spark.sql(f"DROP TABLE {name}")
