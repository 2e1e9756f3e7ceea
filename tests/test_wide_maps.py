"""Feature maps as rows at any size: shuffles, keys that need a look-up, and scores by either way."""

import json
import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plumbline.operators import sparse
from plumbline.plans.scoring import score_wide_map
from plumbline.sources import bundles as B


def bundle(ticker, day, features):
    return json.dumps({"selected_filing": {"form": "10-Q", "report_date": day}, "extraction_input": {"ticker": ticker},
                       "engineered_anomaly_features": features})


def flat_of(spark, documents, monkeypatch):
    """Documents (path, text) as filings whose features are rows."""
    monkeypatch.setattr(B, "MAX_KEYS", 0)
    texts = spark.createDataFrame(documents, "path string, text string")
    return B.flatten_bundles(B.accepted_bundles(B.parse_bundles(texts, "text", "path")))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def random_cells(spark, seed=0):
    """Features of very different sizes with ties, single cells and groups without spread."""
    rng = np.random.default_rng(seed)
    filings = [(f"T{t}", f"2024-0{m}") for t in range(9) for m in range(1, 8)]
    rows = [(*filings[i], f"f{k}", float(rng.integers(0, 4)) if k % 2 else float(rng.normal()))
            for k, n in enumerate([63, 60, 41, 30, 12, 7, 3, 2, 1, 1]) for i in rng.permutation(63)[:n]]
    rows += [(*f, "level", 2.5) for f in filings[:20]]
    return spark.createDataFrame(rows, "ticker string, report_date string, feature string, value double")


def test_cells_are_shuffled_by_feature_and_by_filing_only(spark, monkeypatch):
    cells = random_cells(spark)
    filings, plans, kept = cells.select("ticker", "report_date").distinct(), {}, sparse.materialize

    def materialize(df, name):
        plans[name] = plan_of(df)
        return kept(df, name)

    monkeypatch.setattr(sparse, "materialize", materialize)
    assert sparse.score_cells(filings, cells, strangers=False).count() == filings.count()
    assert "Exchange" not in plans["own-cells"] and "Join" not in plans["own-cells"]
    sums = plans["filing-sums"]
    assert sums.count("Exchange") == 2 and sums.count("FileScan") == 1 and "Join" not in sums


def test_plain_keys_are_not_looked_up_and_numbers_are_read_once(spark, monkeypatch):
    flat = flat_of(spark, [(f"p{i}", bundle(f"T{i}", "d", {"a": i, f"b{i}": 0.5})) for i in range(5)], monkeypatch)
    plan = plan_of(flat.cells)
    assert "Join" not in plan and "Exchange" not in plan
    assert flat.cells._jdf.queryExecution().optimizedPlan().toString().count("try_variant_get") == 1
    assert sorted((r["feature"], r["value"]) for r in flat.cells.collect()) == sorted(
        [("a", float(i)) for i in range(5)] + [(f"b{i}", 0.5) for i in range(5)])


@pytest.mark.parametrize("fits", [True, False])
@pytest.mark.parametrize("shared", [False, True])
def test_odd_keys_are_looked_up(spark, monkeypatch, fits, shared):
    monkeypatch.setattr(B, "fits_broadcast", lambda rows, row_bytes: fits)
    odd = {"Net Sales": 3, "text": "x", "mixed": 1, "target_year": 2024, "ticker": 7, "none": None, "2yr": 4.5, "": 1,
           "plain": 1e400 if not shared else 6}
    odd |= {"net_sales": 9} if shared else {}
    flat = flat_of(spark, [("p1", bundle("A", "d1", odd)), ("p2", bundle("A", "d2", {"mixed": "1", "plain": 5})),
                           ("p3", bundle("B", "d1", {}))], monkeypatch)
    got = {(r["source_path"], r["feature"]): r["value"] for r in flat.cells.collect()}
    # The first key in key order has the shared name.
    wanted = {("p1", "net_sales"): 3.0, ("p1", "f_2yr"): 4.5, ("p2", "plain"): 5.0}
    assert got == wanted | ({("p1", "plain"): 6.0} if shared else {})
    assert flat.cells.count() == len(got)


@pytest.mark.parametrize("limit", [5, 45])
def test_features_score_alike_whatever_their_size(spark, limit):
    """All features by the tasks' way; those with more than ``limit`` cells as hot groups."""
    cells = random_cells(spark)
    small, many = sparse.split_by_size(cells, limit)
    sizes = {r["feature"]: r["count"] for r in cells.groupBy("feature").count().collect()}
    assert {r["feature"] for r in many.select("feature").distinct().collect()} == {f for f, n in sizes.items() if n > limit}
    assert small.count() + many.count() == cells.count()
    (one, none), (other, some) = (sparse.scored_cells(cells, limit=n) for n in (500_000, limit))
    columns = ["ticker", "report_date", "feature", "value", "self_z__value", "peer_z__value", "median"]
    a, b = ({tuple(r)[:3]: tuple(r)[3:] for r in df.select(*columns).collect()} for df in (one, other))
    assert a.keys() == b.keys() and len(a) == cells.count()
    for k in a:
        assert [v is None for v in a[k]] == [v is None for v in b[k]], k
        assert [v for v in a[k] if v is not None] == pytest.approx([v for v in b[k] if v is not None], rel=1e-12), k
    medians = {k[2]: v[-1] for k, v in a.items()}
    whole = sum(m * m for m in medians.values())
    assert none == 0.0 and some > 0
    for df, base in ((one, none), (other, some)):
        assert df.agg(F.sum("__base")).first()[0] + base == pytest.approx(whole)


def test_a_task_cuts_its_cells_between_features(spark, monkeypatch):
    rows = random_cells(spark, 3).withColumn("__hash", F.xxhash64("feature")).orderBy("__hash").toPandas()
    table = pa.Table.from_pandas(rows, preserve_index=False)
    scorer = sparse._scorer(["ticker", "report_date"], 0.05, 0.95)

    def scored(size):
        out = pa.Table.from_batches(list(scorer(iter(table.to_batches(max_chunksize=size)))))
        return {tuple(r.values())[:3]: tuple(r.values())[3:] for r in out.to_pylist()}

    whole = scored(10_000)
    parts = []
    monkeypatch.setattr(sparse, "TASK_CELLS", 7)
    for size in (1, 4, 50):
        parts.append(len(list(sparse._whole_features(iter(table.to_batches(max_chunksize=size))))))
        assert scored(size) == whole
    assert parts[0] > 3 and len(whole) == len(rows)
    assert list(scorer(iter([]))) == [] and list(scorer(iter(table.slice(0, 0).to_batches()))) == []


def test_a_document_that_gives_way_to_another_has_no_part(spark, monkeypatch):
    days = [(f"T{t}", f"2024-0{m}-01") for t in range(4) for m in range(1, 6)]
    documents = [(f"a/{t}/{d}", bundle(t, d, {"x": i * 1.5, "y": (i * 7) % 5, f"own{i}": 3})) for i, (t, d) in enumerate(days)]
    again = [(f"b/{t}/{d}", bundle(t, d, {"x": -1e6, "late": 4})) for t, d in days[:7]]
    undated = [("c/1", json.dumps({"selected_filing": {"form": "10-Q"}, "extraction_input": {"ticker": "T0"},
                                   "engineered_anomaly_features": {"x": 1e9}}))]
    scored = {}
    for name, some in (("alone", documents), ("again", documents + again), ("undated", documents + undated)):
        rows = score_wide_map(flat_of(spark, some, monkeypatch)).drop("anomaly_score_0_100").collect()
        scored[name] = {(r["ticker"], r["report_date"]): tuple(
            None if isinstance(v, float) and math.isnan(v) else v for v in r) for r in rows}
    assert scored["alone"].keys() == set(days)
    assert scored["alone"] == scored["again"] == scored["undated"]


def test_no_documents_and_no_cells(spark, monkeypatch):
    flat = flat_of(spark, [("p", bundle("A", "d", {"x": 1}))], monkeypatch)
    empty = B.FlatFilings(flat.table.limit(0), [], cells=flat.cells.limit(0))
    assert score_wide_map(empty).count() == 0
    bare = score_wide_map(B.FlatFilings(flat.table, [], cells=flat.cells.limit(0))).first()
    assert bare["num_features_used"] == 0 and bare["mahalanobis_distance"] == 0.0
