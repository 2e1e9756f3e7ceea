"""Plan shapes: what must not happen at scale, checked on the physical plan."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import plumbline as pl
from plumbline.operators import groups
from plumbline.operators.dedup import first_per_key
from plumbline.operators.zscores import attach_zscores, quartile_stats
from plumbline import names
from plumbline.session import materialize

FEATURES = ["f1", "f2", "f3"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def panel(spark, tmp_path_factory):
    rng = np.random.default_rng(0)
    rows = [(f"T{t}", f"2024-{q:02d}-01", *map(float, rng.normal(size=3)))
            for t in range(20) for q in range(1, 10)]
    path = str(tmp_path_factory.mktemp("panel") / "t")
    spark.createDataFrame(
        rows, "ticker string, report_date string, f1 double, f2 double, f3 double").write.parquet(path)
    return spark.read.parquet(path)


def test_scoring_plan_has_no_row_at_a_time_python_and_no_cross_join(panel):
    plan = plan_of(pl.score_filings(panel, FEATURES, ordered=False))
    for bad in ("BatchEvalPython", "NestedLoop", "CartesianProduct"):
        assert bad not in plan, bad
    # The one single-partition step sums the totals of the value ranges, one row per range.
    singles = plan.split("Exchange SinglePartition")[1:]
    assert len(singles) == 1 and "value-ranges" in singles[0][:singles[0].index("FileScan") + 600]
    assert "partial_sum(copies" in singles[0]


def test_dedup_limits_copies_before_the_shuffle(panel):
    plan = plan_of(first_per_key(panel))
    assert re.search(r"WindowGroupLimit.*Final[\s\S]*Exchange[\s\S]*WindowGroupLimit.*Partial", plan)


def test_winsorize_is_a_projection(panel):
    plan = plan_of(pl.winsorize(panel, FEATURES))
    assert "Exchange" not in plan and "Join" not in plan and "Window" not in plan


def test_z_scores_share_one_aggregate_and_one_join_per_grouping(panel):
    stats = quartile_stats(panel, ["report_date"], FEATURES)
    plan = plan_of(attach_zscores(panel, [(stats, names.peer_z)], FEATURES))
    assert plan.count("BroadcastHashJoin") == 1
    assert plan.count("SinglePartition") == 0


def test_many_groups_shuffle_instead_of_broadcast(panel, monkeypatch):
    monkeypatch.setattr(groups, "BROADCAST_BYTES", 0)
    spark = panel.sparkSession
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(pl.self_history_zscores(panel, FEATURES))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Broadcast" not in plan and "NestedLoop" not in plan


def test_measuring_reads_only_what_it_needs(panel):
    stats = quartile_stats(panel, ["report_date"], ["f2"])
    plan = plan_of(stats.table)
    assert "ReadSchema: struct<report_date:string,f2:double>" in plan


def test_top_n_never_sorts_the_table(panel):
    df = panel.select("ticker", "report_date", F.col("f1").alias("anomaly_score_0_100"))
    assert "TakeOrderedAndProject" in plan_of(pl.top_n(df, 5))


def test_trend_ranges_over_entity_and_quarter(panel):
    plan = plan_of(pl.company_trend(panel.withColumn("filing_date", F.col("report_date"))))
    assert "rangepartitioning(ticker" in plan and "calendar_quarter" in plan


def test_both_groupings_are_measured_by_one_shuffle(panel, monkeypatch):
    from plumbline.operators import quantiles
    written = []
    kept = quantiles.materialize
    monkeypatch.setattr(quantiles, "materialize", lambda df, name: written.append((name, plan_of(df))) or kept(df, name))
    scored = pl.self_and_peer_zscores(panel, FEATURES)
    plans = [plan for name, plan in written if name == "group-stats"]
    assert len(plans) == 1 and plans[0].count("Exchange hashpartitioning") == 1
    assert "collect_list" in plans[0] and plans[0].count("FileScan") == 1
    # Nothing is measured again when the scores are joined.
    assert "collect_list" not in plan_of(scored) and plan_of(scored).count("group-stats") == 2


def test_a_table_too_large_to_broadcast_is_shuffled(spark):
    # The tables are small to Spark, as written tables of many rows are; what was counted decides.
    rows = spark.range(2000).select((F.col("id") % 50).alias("k"), "id")
    table = materialize(spark.range(40).select(F.col("id").alias("k"), F.lit(40).alias("n"), F.lit("x").alias("v")), "counted")
    many = groups.BROADCAST_BYTES
    for joined in (groups.attach_small(rows, table, ["k"], many, 64, "inner"),
                   groups.attach_counted(rows, table, "k", many, 64, "n"),
                   groups.attach_counted(rows, table, "k", many, 64, "n", hot_rows=30)):
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan
        got = joined.select("k", "id", "v").collect()
        assert sorted(r["id"] for r in got) == [i for i in range(2000) if i % 50 < 40]
    small = groups.attach_counted(rows, table, "k", 40, 64, "n")
    assert small.count() == 1600 and "SortMergeJoin" not in small._jdf.queryExecution().executedPlan().toString()
