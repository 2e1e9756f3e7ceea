import json

import pytest
from pyspark.sql import functions as F

import plumbline as pl
from plumbline import names
from plumbline.plans.flatten import flatten_bundle_folder, flatten_filings_table
from plumbline.sinks import outputs
from plumbline.sinks.outputs import publish_outputs, publish_set, write_csv
from plumbline.sources import bundles as B
from plumbline.sources import tables as T


def bundle(ticker="A", form="10-Q", features=None, **filing):
    return {
        "selected_filing": {"form": form, "company_name": f"{ticker} Inc", "cik": "0000320193",
                            "report_date": "2024-03-31", "filing_date": "2024-05-01",
                            "accession_number": "1-2", **filing},
        "selected_filing_url": "http://x/" + str(ticker),
        "extraction_input": {"ticker": ticker},
        "engineered_anomaly_features": {"Rev Growth%": 1.5} if features is None else features,
    }


@pytest.fixture
def folder(tmp_path):
    def put(path, content):
        target = tmp_path / "bundles" / path
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_text(content if isinstance(content, str) else json.dumps(content, indent=1))

    put("AAA/1_analysis_ready.json", bundle("AAA", features={
        "Rev Growth%": 1.5, "2yr": 3, "target_year": 2024, "feature_count": 9, "note": "text",
        "digits": "5", "flag": True, "list": [1, 2], "nothing": None, "a.b\"c'd": 4,
        "Dup": 1.0, "dup": 2.0, "ticker": 77}))
    put("AAA/2_analysis_ready.json", bundle("AAA", report_date="2024-06-30",
                                            features={"dup": 8, "mixed": 1, "Rev Growth%": None}))
    put("AAA/3_other.json", bundle("AAA"))
    put("BBB/1_analysis_ready.json", bundle("BBB", features={}))
    put("CCC/1_analysis_ready.json", bundle("CCC", features={"mixed": "x", "Rev Growth%": -2}))
    put("CCC/2_analysis_ready.json", bundle("CCC", form="10-Q/A"))
    put("DDD/1_analysis_ready.json", '{"selected_filing": {"form": "10-Q"')
    put("DDD/2_analysis_ready.json", bundle("DDD", report_date="2024-06-30"))
    put("EEE/1_analysis_ready.json", bundle(""))
    put("EEE/2_analysis_ready.json", {"selected_filing": None, "extraction_input": None})
    put("EEE/3_analysis_ready.json", bundle("FFF"))
    return str(tmp_path / "bundles")


def tickers_of(flat):
    return sorted(r["ticker"] for r in flat.table.select("ticker").collect())


def test_flatten_folder(spark, folder):
    flat = pl.load_bundles(spark, folder)
    assert tickers_of(flat) == ["AAA", "AAA", "CCC", "DDD", "FFF"]
    assert set(flat.features) == {"rev_growth_", "f_2yr", "a_b_c_d", "dup"}
    rows = {(r["ticker"], r["report_date"]): r for r in flat.table.collect()}
    first = rows["AAA", "2024-03-31"]
    assert first["cik"] == "0000320193" and first["filing_url"] == "http://x/AAA"
    assert (first["rev_growth_"], first["f_2yr"], first["a_b_c_d"], first["dup"]) == (1.5, 3.0, 4.0, 1.0)
    assert (first["note"], first["digits"], first["flag"]) == ("text", "5", "true")
    assert rows["AAA", "2024-06-30"]["dup"] == 8.0
    assert rows["AAA", "2024-06-30"]["rev_growth_"] is None
    assert rows["CCC", "2024-03-31"]["mixed"] == "x" and first["nothing"] is None
    assert flat.collisions == {"dup": ["Dup", "dup"], "ticker": ["ticker"]}
    assert "target_year" not in flat.table.columns and "feature_count" not in flat.table.columns


def test_prefix_and_allow_list(spark, folder):
    assert tickers_of(pl.load_bundles(spark, folder, tickers=["CCC", "missing"])) == ["CCC"]
    # The folder EEE holds a bundle of FFF: reading EEE only, it is not on the list.
    assert tickers_of(pl.load_bundles(spark, folder, tickers=["EEE"])) == []
    assert tickers_of(pl.load_bundles(spark, folder, tickers=["no", "where"])) == []


def test_first_tickers_count_before_the_empty_ones_go(spark, folder):
    assert tickers_of(pl.load_bundles(spark, folder, max_tickers=2)) == ["AAA", "AAA"]
    assert tickers_of(pl.load_bundles(spark, folder, max_tickers=3)) == ["AAA", "AAA", "CCC"]


def test_other_form(spark, folder):
    assert tickers_of(pl.load_bundles(spark, folder, form_type="10-Q/A")) == ["CCC"]


def test_malformed_documents_are_listed(spark, folder):
    bad = B.malformed_bundles(B.scan_bundles(spark, folder)).collect()
    assert [r["source_path"].rsplit("/bundles/", 1)[1] for r in bad] == ["DDD/1_analysis_ready.json"]


def test_repeated_keys_and_non_finite_numbers(spark, tmp_path):
    """Neither loses the document: the last value counts, and NaN or infinity is missing."""
    (tmp_path / "A").mkdir()
    text = json.dumps(bundle("A", features={"x": 1}))
    (tmp_path / "A" / "1_analysis_ready.json").write_text(
        text.replace('{"x": 1}', '{"x": 1, "y": NaN, "w": -Infinity, "v": 1e-7, "x": 2}'))
    (tmp_path / "A" / "2_analysis_ready.json").write_text(json.dumps(bundle("A", features={"y": 3})))
    flat = pl.load_bundles(spark, str(tmp_path))
    rows = sorted(tuple(r) for r in flat.table.select("x", "v").na.fill(0.0).collect())
    assert rows == [(0.0, 0.0), (2.0, 1e-7)]
    assert flat.table.where("y = 3 AND w IS NULL").count() == 1
    assert flat.table.where("isnan(y)").count() == 0


def test_long_allow_list_joins(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "t string")
    many = [f"x{i}" for i in range(1200)] + ["b"]
    assert [r[0] for r in B.allow_list(df, F.col("t"), many).collect()] == ["b"]


def test_flatten_job_writes_features_and_keys(spark, folder, tmp_path):
    flat = flatten_bundle_folder(spark, folder, features_path=str(tmp_path / "f"),
                                 keys_path=str(tmp_path / "k"))
    assert T.read_feature_keys(spark, str(tmp_path / "k")) == flat.features
    assert T.read_features(spark, str(tmp_path / "f")).count() == 5
    scored = pl.score_filings(flat.table, flat.features, listing_order=[F.col("source_path")])
    assert scored.count() == 5


def test_packs_of_single_files_flatten_alike(spark, folder, tmp_path):
    packed = str(tmp_path / "packed")
    B.pack_folder(spark, folder, packed)
    for options in ({}, {"tickers": ["CCC", "EEE"]}, {"max_tickers": 3}):
        one, many = B.load_bundles(spark, folder, **options), B.load_packs(spark, packed, **options)
        assert many.counts == one.counts and many.features == one.features
        rows = [sorted(map(str, f.table.collect())) for f in (one, many)]
        assert rows[0] == rows[1]
    chosen = spark.createDataFrame([("DDD",), ("AAA",), ("none",), (None,)], "folder string")
    listed = B.scan_packs(spark, packed, ["AAA", "DDD"]).select("source_path").collect()
    assert sorted(B.scan_packs(spark, packed, chosen).select("source_path").collect()) == sorted(listed)
    assert len(listed) == 4


def test_many_bundles_take_few_files(spark, tmp_path):
    n, root = 3000, tmp_path / "packs"
    texts = spark.range(n).select(
        F.concat(F.lit('{"extraction_input": {"ticker": "T'), F.col("id") % 500, F.lit('"}, "selected_filing": {"form": "10-Q"},\n'),
                 F.lit('"engineered_anomaly_features": {"x": '), "id", F.lit("}}")).alias("text"),
        F.concat(F.lit("T"), F.col("id") % 500).alias("folder"), F.col("id").cast("string").alias("path"))
    B.save_packs(texts.union(texts.limit(1).select(F.lit(None), "folder", "path")), str(root), "text", "path", "folder")
    assert len(list(root.rglob("*.parquet"))) <= B.PACKS
    flat = B.load_packs(spark, str(root))
    assert flat.counts["documents"] == flat.counts["kept"] == n
    assert flat.table.agg(F.sum("x")).first()[0] == n * (n - 1) / 2
    assert B.load_packs(spark, str(root), tickers=["T7"]).table.count() == n // 500


def test_no_bundles_at_all(spark, tmp_path):
    B.save_packs(spark.createDataFrame([], "text string, path string, folder string"), str(tmp_path / "p"), "text", "path", "folder")
    assert B.load_packs(spark, str(tmp_path / "p")).counts["documents"] == 0


def test_bundle_queries_write_few_files(spark, tmp_path, monkeypatch):
    from plumbline.catalog import queries as Q

    days = spark.range(400).select(
        (F.col("id") % 200).alias("user_id"), F.timestamp_seconds(1704067200 + F.col("id") * 6000).alias("ts"),
        F.lit(1.5).alias("value"))
    days.write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(Q, "scratch_path", lambda spark, name: str(tmp_path / name))
    Q.bundle_counts(spark, str(tmp_path)).collect()
    written = tmp_path / "bundles"
    assert len([f for f in written.rglob("*") if f.suffix in (".txt", ".parquet", ".json")]) <= 3 * B.PACKS


def test_filings_table(spark, tmp_path):
    df = spark.createDataFrame(
        [("A", "10-Q", 1.0, 2, True, 2024), ("B", "10-K", 2.0, 3, False, 2024),
         ("C", "10-Q", float("nan"), 4, True, 2024)],
        "ticker string, form string, x double, n int, flag boolean, target_year int")
    flat = flatten_filings_table(spark, df)
    assert flat.features == ["x", "n"] and "form_type" in flat.table.columns
    rows = {r["ticker"]: (r["x"], r["n"]) for r in flat.table.collect()}
    assert rows == {"A": (1.0, 2.0), "C": (None, 4.0)}
    both = T.load_filings_table(df.withColumn("form_type", F.lit("kept")))
    assert {r["form_type"] for r in both.collect()} == {"kept"} and "form" in both.columns


def test_form_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("A", "10-Q", 1.0), ("B", "10-K", 2.0)],
                          "ticker string, form string, x double").write.parquet(path)
    plan = T.load_filings_table(spark.read.parquet(path)).select("x")._jdf.queryExecution().toString()
    assert "EqualTo(form,10-Q)" in plan and "ReadSchema: struct<form:string,x:double>" in plan


def test_records_json_array_and_lines(spark, tmp_path):
    records = [{"ticker": "NA", "cik": "0001", "x": 1.5}, {"ticker": "B", "cik": None, "x": None}]
    (tmp_path / "array.json").write_text(json.dumps(records, indent=2))
    schema = "ticker string, cik string, x double"
    got = T.read_features(spark, str(tmp_path / "array.json"), schema, "json").collect()
    assert [tuple(r) for r in got] == [("NA", "0001", 1.5), ("B", None, None)]
    df = spark.createDataFrame([("NA", "0001", 1.5)], schema)
    T.write_features(df, str(tmp_path / "lines"), "json")
    assert T.read_feature_lines(spark, str(tmp_path / "lines"), schema).collect() == df.collect()


def test_scores_csv_keeps_text_and_numbers(spark, tmp_path):
    panel = spark.createDataFrame(
        [(f"{t}", "0000012", f"2024-0{q}-01", 'He said "x, y"', float(t * q), float(q - t * t))
         for t in range(1, 6) for q in range(1, 6)],
        "ticker string, cik string, report_date string, company_name string, f1 double, f2 double")
    panel = panel.unionAll(panel.limit(1).withColumn("ticker", F.lit("NA")))
    scores = pl.score_filings(panel, ["f1", "f2"])
    write_csv(scores, str(tmp_path / "csv"))
    back = T.read_scores_csv(spark, str(tmp_path / "csv"), ["f1", "f2"])
    assert back.schema.names == scores.schema.names
    key = ["ticker", "report_date"]
    left = [tuple(r)[:7] + tuple(r)[7:-1] for r in scores.orderBy(key).collect()]
    right = [tuple(r)[:7] + tuple(r)[7:-1] for r in back.orderBy(key).collect()]
    assert left == right


def test_csv_keeps_line_breaks_empty_text_and_missing_apart(spark, tmp_path):
    names_of = ["two\nlines", "", None, "back\\slash \\n", "\r\n", "NA", "\\N", 'quo"te, comma']
    panel = spark.createDataFrame(
        [(f"T{i}", f"2024-0{q}-01", name, float(i * q), float(q - i)) for i, name in enumerate(names_of)
         for q in (1, 2)], "ticker string, report_date string, company_name string, f1 double, f2 double")
    scores = pl.score_filings(panel, ["f1", "f2"], distance="l2")
    write_csv(scores, str(tmp_path / "csv"))
    back = T.read_scores_csv(spark, str(tmp_path / "csv"), ["f1", "f2"])
    shown = lambda df: sorted((r["ticker"], r["report_date"], r["company_name"] or repr(r["company_name"]))
                              for r in df.collect())
    assert shown(back) == shown(scores)


def test_a_missing_root_is_an_error_and_missing_ticker_folders_are_not(spark, folder):
    from pyspark.errors import AnalysisException
    with pytest.raises(AnalysisException):
        B.scan_bundles(spark, folder + "-nowhere")
    with pytest.raises(AnalysisException):
        B.scan_bundles(spark, folder + "-nowhere", ["AAA"])
    assert B.scan_bundles(spark, folder, ["XYZ"]).count() == 0
    assert B.scan_bundles(spark, folder, ["AAA", "XYZ"]).count() == 2


def test_flatten_reports_what_it_left_out(spark, folder):
    flat = pl.load_bundles(spark, folder)
    assert flat.counts == {
        "documents": 10, "malformed": 1, "other_form": 2, "no_ticker": 1, "not_listed": 0, "over_limit": 0,
        "no_features": 1, "kept": 5}
    assert flat.table.count() == 5
    counts = pl.load_bundles(spark, folder, tickers=["AAA", "BBB"]).counts
    assert (counts["documents"], counts["no_features"]) == (3, 1)


@pytest.mark.parametrize("most", [1, 2, 100])
def test_counts_with_a_limit_on_tickers_add_up_to_the_table(spark, folder, most):
    flat = pl.load_bundles(spark, folder, max_tickers=most)
    assert flat.counts["kept"] == flat.table.count()
    assert flat.counts["documents"] == flat.counts["kept"] + sum(flat.counts[r] for r in B.REASONS)
    assert (flat.counts["over_limit"] > 0) == (most < 3)


def test_too_many_keys_for_columns_become_rows(spark, folder, monkeypatch, tmp_path):
    wide = pl.load_bundles(spark, folder)
    monkeypatch.setattr(B, "MAX_KEYS", 1)
    flat = flatten_bundle_folder(spark, folder, features_path=str(tmp_path / "features"))
    assert flat.features == [] and flat.table.count() == wide.table.count()
    got = {(r["source_path"], r["feature"]): r["value"] for r in flat.cells.collect()}
    wanted = {(r["source_path"], f): r[f] for r in wide.table.collect() for f in wide.features if r[f] is not None}
    assert got == wanted and wanted


def test_a_set_is_published_whole_or_not_at_all(spark, tmp_path):
    root = str(tmp_path / "pub")
    with pytest.raises(FileNotFoundError):
        outputs.published_set(spark, root)
    one, two = spark.range(3).toDF("v"), spark.createDataFrame([("a\0b\\n\n\r", 1)], "t string, n int")
    done, skipped = publish_set({names.SCORES_TABLE: one, names.REVIEW_TABLE: two}, root)
    assert skipped == [] and set(done) == {names.SCORES_TABLE, names.REVIEW_TABLE}
    broken = two.select(F.raise_error(F.lit("no second table")).cast("string").alias("t"))
    with pytest.raises(Exception, match="no second table"):
        publish_set({names.SCORES_TABLE: one.limit(1), names.REVIEW_TABLE: broken}, root)
    assert outputs.published_versions(spark, root) == [1]
    assert outputs.read_published(spark, root, names.SCORES_TABLE).count() == 3
    publish_set({names.SCORES_TABLE: one.limit(2), names.REVIEW_TABLE: two}, root, "csv")
    assert outputs.published_set(spark, root)["version"] == 2
    back = outputs.read_published(spark, root, names.REVIEW_TABLE, schema=two.schema)
    assert [tuple(r) for r in back.collect()] == [("a\0b\\n\n\r", 1)]
    assert outputs.read_published(spark, root, names.SCORES_TABLE, version=1).count() == 3
    # What the failed publication left, and the first set.
    assert len(outputs.prune_published(spark, root, keep=1)) == 2
    assert outputs.published_versions(spark, root) == [2]
    assert outputs.read_published(spark, root, names.REVIEW_TABLE, schema=two.schema).count() == 1
    assert publish_set({names.SCORES_TABLE: None}, root) == ({}, [names.SCORES_TABLE, names.REVIEW_TABLE])
    with pytest.raises(FileExistsError):
        outputs._put_new(spark, f"{root}/{outputs.MANIFESTS}/00000002.json", "{}")


def test_line_codes_read_back_whatever_the_text(spark):
    texts = ["", "\\", "\\\\", "\\n", "\n", "\\\n", "\0", "a\0\\r\r\n", "\\\\n\\", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    back = df.select("i", outputs.unescape_lines(outputs.escape_lines(F.col("t"))).alias("t")).collect()
    assert [r["t"] for r in sorted(back)] == texts


def test_publish_outputs_skips_missing_and_replaces(spark, tmp_path):
    root = str(tmp_path / "pub")
    df = spark.range(3).toDF("v")
    done, skipped = publish_outputs({names.SCORES_TABLE: df}, root, "csv")
    assert done == {names.SCORES_TABLE: f"{root}/{names.SCORES_TABLE}"}
    assert skipped == [names.REVIEW_TABLE]
    publish_outputs({names.SCORES_TABLE: spark.range(1).toDF("v"), names.REVIEW_TABLE: df}, root, "csv")
    assert spark.read.option("header", True).csv(done[names.SCORES_TABLE]).count() == 1
