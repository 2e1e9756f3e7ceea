import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from plumbline.operators import groups, quantiles
from plumbline.operators.quantiles import (
    attach_group_stats, column_quantiles, group_quantiles, n_col, q_col,
)

PROBS = (0.05, 0.25, 0.5, 0.75, 0.95)


@pytest.fixture(scope="module")
def skewed():
    """One group holds a third of the rows; values include long runs of ties and holes."""
    rng = np.random.default_rng(7)
    n = 6000
    key = np.where(rng.random(n) < 1 / 3, "hot", rng.integers(0, 40, n).astype(str))
    a = rng.lognormal(0, 3, n)
    b = np.where(rng.random(n) < 0.6, 5.0, rng.normal(0, 1, n)).round(3)
    c = np.where(rng.random(n) < 0.5, np.nan, rng.integers(-3, 3, n))
    return pd.DataFrame({"k": key, "a": a, "b": b, "c": c, "d": 1.0})


def frame(spark, pdf, parts=5):
    return spark.createDataFrame(
        [tuple(None if v != v else v for v in row) for row in pdf.itertuples(index=False)],
        "k string, a double, b double, c double, d double").repartition(parts)


@pytest.mark.parametrize("cells", [500_000, 1200, 120])
def test_group_quantiles_equal_brute_force(spark, skewed, cells):
    df = frame(spark, skewed)
    stats = group_quantiles(df, ["k"], list("abcd"), PROBS, cells=cells, final_values=16)
    assert (stats.hot is not None) == (cells < 500_000)
    got = {r["k"]: r for r in stats.table.collect()}
    assert set(got) == set(skewed.k)
    for key, part in skewed.groupby("k"):
        for f in "abcd":
            known = part[f].dropna()
            assert got[key][n_col(f)] == len(known)
            if len(known):
                np.testing.assert_allclose(
                    got[key][q_col(f)], known.quantile(list(PROBS)), rtol=1e-12, atol=1e-12)


@pytest.mark.parametrize("cells", [500_000, 100])
def test_column_quantiles_equal_brute_force(spark, skewed, cells):
    got = column_quantiles(frame(spark, skewed), list("abcd"), [0.0, *PROBS, 1.0], cells, 10)
    for f in "abcd":
        known = skewed[f].dropna()
        assert got[f][0] == len(known)
        np.testing.assert_allclose(got[f][1], known.quantile([0.0, *PROBS, 1.0]), rtol=1e-12)


def test_wholly_missing_and_tiny_columns(spark):
    df = spark.createDataFrame([(None, 1.0), (None, None)], "a double, b double")
    assert column_quantiles(df, ["a", "b"], [0.5]) == {"a": (0, None), "b": (1, [1.0])}
    narrowed = column_quantiles(df, ["a", "b"], [0.5], cells=1, final_values=1)
    assert narrowed == {"a": (0, None), "b": (1, [1.0])}


@pytest.mark.parametrize("broadcast_bytes", [64 << 20, 2000, 0])
def test_attach_gives_every_row_its_group(spark, skewed, monkeypatch, broadcast_bytes):
    """Broadcast, shuffle with spread hot rows, and copied tables all give the same rows."""
    monkeypatch.setattr(groups, "BROADCAST_BYTES", broadcast_bytes)
    pdf = pd.concat([skewed, skewed.head(3).assign(k=None)])
    df = spark.createDataFrame(
        [tuple(None if v is None or v != v else v for v in row)
         for row in pdf.itertuples(index=False)],
        "k string, a double, b double, c double, d double")
    stats = group_quantiles(df, ["k"], ["a"], (0.5,), cells=400)
    assert stats.sizes.n_hot == 1
    rows = attach_group_stats(df, stats)
    assert rows.count() == len(pdf)
    medians = skewed.groupby("k").a.median().to_dict()
    got = rows.select("k", F.col(q_col("a"))[0].alias("m")).distinct().collect()
    assert {r["k"]: r["m"] for r in got} == pytest.approx({**medians, None: None})


def test_rows_without_a_key_are_spread_over_the_join(spark, monkeypatch):
    """With 90 % of the keys missing no task of the shuffle join gets them all."""
    monkeypatch.setattr(groups, "BROADCAST_BYTES", 0)
    before = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    df = spark.range(20_000).select(
        F.when(F.col("id") % 10 == 0, (F.col("id") % 37).cast("string")).alias("k"),
        F.col("id").cast("double").alias("a"))
    stats = group_quantiles(df, ["k"], ["a"], (0.5,))
    for c, v in zip(before, ("-1", "false")):
        spark.conf.set(c, v)
    try:
        joined = attach_group_stats(df, stats)
        sizes = [r["n"] for r in joined.groupBy(F.spark_partition_id().alias("p")).agg(
            F.count(F.lit(1)).alias("n")).collect()]
        assert sum(sizes) == 20_000 and max(sizes) < 3 * 20_000 / 8
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)


def test_group_sizes_ignore_missing_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "k string, v int")
    sizes = groups.group_sizes(df, ["k"], 1)
    assert (sizes.n_groups, sizes.n_rows, sizes.n_hot) == (1, 2, 0)


@pytest.mark.parametrize("sketch_values", [300])
def test_brackets_from_a_small_sample_are_still_exact(spark, skewed, monkeypatch, sketch_values):
    """A poor sample costs passes, never exactness."""
    from plumbline.operators import quantiles
    monkeypatch.setattr(quantiles, "SKETCH_VALUES", sketch_values)
    got = column_quantiles(frame(spark, skewed), list("abc"), PROBS, 100, 30)
    for f in "abc":
        np.testing.assert_allclose(got[f][1], skewed[f].dropna().quantile(list(PROBS)), rtol=1e-12)


@pytest.mark.parametrize("packed", [0, 400, 50_000])
@pytest.mark.parametrize("cells", [500_000, 3000])
def test_several_groupings_at_once_equal_brute_force(spark, skewed, monkeypatch, packed, cells):
    """Packed, sorted and narrowed groups side by side, keys missing in either grouping."""
    monkeypatch.setattr(quantiles, "PACKED_CELLS", packed)
    pdf = skewed.assign(g=skewed.index % 7, day=skewed.index % 3)
    pdf.loc[pdf.index % 11 == 0, "g"] = np.nan
    pdf.loc[pdf.k == "3", "k"] = None
    rows = [tuple(None if v != v else v for v in row) for row in pdf.itertuples(index=False)]
    df = spark.createDataFrame(
        [(*r[:5], None if r[5] is None else int(r[5]), r[6]) for r in rows],
        "k string, a double, b double, c double, d double, g int, day int").repartition(4)
    groupings = [["k"], ["g", "day"], ["day"]]
    found = quantiles.groupings_quantiles(df, groupings, list("abcd"), PROBS, cells=cells, final_values=16)
    for by, stats in zip(groupings, found):
        assert [c for c in stats.table.columns if "__" not in c] == by
        got = {tuple(r[c] for c in by): r for r in stats.table.collect()}
        wanted = {key if isinstance(key, tuple) else (key,): part
                  for key, part in pdf.dropna(subset=by).groupby(by)}
        assert set(got) == {tuple(k if isinstance(k, str) else int(k) for k in key) for key in wanted}
        for key, part in wanted.items():
            row = got[tuple(k if isinstance(k, str) else int(k) for k in key)]
            for f in "abcd":
                known = part[f].dropna()
                assert row[n_col(f)] == len(known)
                if len(known):
                    np.testing.assert_allclose(row[q_col(f)], known.quantile(list(PROBS)), rtol=1e-12, atol=1e-12)
