"""Records JSON in any shape and split, lists as tables, saved filings and sketches."""

import json
import random

import pytest
from pyspark.sql import functions as F

from plumbline.operators import sketches
from plumbline.operators.listed import listed_rows
from plumbline.sources.records import read_records
from plumbline.sources.tables import filings_of_quarters, save_filings_table

SCHEMA = "i int, t string, o struct<a:int,b:string>, l array<string>"


def some_records(seed, n, nested):
    rng = random.Random(seed)
    pieces = ["}", "{", '"', "\\", "},{", '\\"}', "[", "]", ",", "\n", "é", "a", " ", '{"i":1}']
    text = lambda: "".join(rng.choice(pieces) for _ in range(rng.randint(0, 9)))
    out = []
    for i in range(n):
        record = {"i": i, "t": rng.choice([None, text(), text()]) if nested else f"plain {i}"}
        if nested:
            record |= {"o": rng.choice([None, {}, {"a": i, "b": text()}]), "l": rng.choice([None, [], [text(), "}"]]), "x": {}}
        out.append(record)
    return out


@pytest.mark.parametrize("nested", [False, True])
@pytest.mark.parametrize("indent", [None, 2])
def test_arrays_of_records_read_back_from_many_splits(spark, tmp_path, nested, indent):
    records = some_records(3, 700, nested)
    (tmp_path / "one.json").write_text(json.dumps(records[:400], ensure_ascii=False, indent=indent))
    (tmp_path / "two.json").write_text("\n".join(json.dumps(r) for r in records[400:]) + "\n")
    (tmp_path / "empty.json").write_text("[]")
    (tmp_path / "nothing.json").write_text("")
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        schema = spark.createDataFrame([], SCHEMA).schema
        found = read_records(spark, str(tmp_path), schema)
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 5
        got = sorted((r.asDict(recursive=True) for r in found.collect()), key=lambda r: r["i"])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    assert got == [{"i": r["i"], "t": r["t"], "l": r.get("l"), "o": None if r.get("o") is None else {
        "a": r["o"].get("a"), "b": r["o"].get("b")}} for r in records]


def test_a_broken_record_is_an_error(spark, tmp_path):
    (tmp_path / "one.json").write_text('[{"i": 1}, {"i": x}]')
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|parse"):
        read_records(spark, str(tmp_path), spark.createDataFrame([], "i int").schema).collect()


def test_a_long_list_reduces_the_rows_before_they_are_shuffled(spark):
    rows = spark.range(5000).select((F.col("id") % 1000).alias("k"), F.when(F.col("id") % 7 > 0, F.col("id")).alias("n"))
    allowed = spark.range(0, 4000, 13).select(F.col("id").cast("int").alias("of")).union(
        spark.createDataFrame([(None,), (13,)], "of int"))
    wanted = sorted(r["k"] for r in rows.where(F.col("k") % 13 == 0).collect())
    assert sorted(r["k"] for r in listed_rows(rows, "k", allowed, "of").collect()) == wanted
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        held = listed_rows(rows, "k", allowed, "of", 0)
        plan = held._jdf.queryExecution().executedPlan().toString()
        assert sorted(r["k"] for r in held.collect()) == wanted and held.columns == rows.columns
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    # The bitmap's join lies below the shuffle of the rows to the list.
    assert plan.index("SortMergeJoin") < plan.index("Exchange hashpartitioning") < plan.index("BroadcastHashJoin")
    assert listed_rows(rows, "k", allowed.limit(0), "of", 0).count() == 0
    assert listed_rows(rows, "n", rows.select("n"), broadcast_bytes=0).count() == rows.where("n IS NOT NULL").count()


def test_saved_filings_are_pruned_by_form_and_at_run_time_by_quarter(spark, tmp_path):
    filings = spark.range(800).select(
        F.col("id"), F.when(F.col("id") % 2 == 0, "10-Q").otherwise("10-K").alias("form"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 1400).cast("int")).alias("report_date"))
    saved = save_filings_table(filings, "filings_of_the_test", str(tmp_path / "filings"))
    quarters = spark.createDataFrame([("2020Q3", 1), ("2021Q1", 1), ("2021Q2", 0)], "calendar_quarter string, open int")
    quarters.write.parquet(str(tmp_path / "quarters"))
    chosen = spark.read.parquet(str(tmp_path / "quarters")).where("open = 1")
    found = filings_of_quarters(saved, chosen)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "(form" in plan[plan.index("PartitionFilters"):][:200]
    assert {r["form_type"] for r in found.select("form_type").distinct().collect()} == {"10-Q"}
    assert sorted(r["id"] for r in found.collect()) == sorted(r["id"] for r in saved.where(
        "form = '10-Q' AND calendar_quarter IN ('2020Q3', '2021Q1')").collect())
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        again = filings_of_quarters(saved, chosen)
        again.collect()
        scan = again._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
        n_read, n_files = scan.metrics().apply("numFiles").value(), saved.where("form = '10-Q'").inputFiles()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # Two quarters of sixteen.
    assert 0 < n_read <= len(n_files) / 4
    spark.sql("DROP TABLE filings_of_the_test")


def test_sketches_of_halves_merge_to_the_whole(spark):
    rows = spark.range(30_000).select((F.col("id") % 3).alias("g"), (F.col("id") % 2).alias("half"),
                                      F.when(F.col("id") % 10 > 0, F.sqrt("id")).alias("v"),
                                      F.lit(None).cast("double").alias("none"), (F.col("id") % 4000).alias("u"))
    halves = sketches.quantile_sketches(rows, ["g", "half"], ["v", "none"])
    merged = sketches.merged_quantile_sketches(halves, ["g"], ["v", "none"])
    read = sketches.sketched_quantiles(merged, ["g"], ["v", "none"], [0.0, 0.5, 0.9])
    got = {(r["g"], r["prob"]): (r["n"], r["value"]) for r in read.collect()}
    assert len(got) == 9 and {n for n, _ in got.values()} == {9000}
    for (g, p), (_, value) in got.items():
        held = sorted(r["v"] for r in rows.where((F.col("g") == g) & F.col("v").isNotNull()).collect())
        assert abs(sum(v < value for v in held) / len(held) - p) < 0.01
    daily = sketches.distinct_sketches(rows, ["half"], "u")
    assert abs(sketches.sketched_distinct(daily).first()["n_distinct"] - 4000) < 80
    assert sketches.sketched_distinct(daily.limit(0), ["half"]).count() == 0
