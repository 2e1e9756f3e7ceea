import math

import pytest
from pyspark.sql import functions as F

from plumbline.functions import expressions as X
from plumbline.functions.chi2 import chi2_cdf, chi2_quantile


def one(spark, column, **values):
    schema = ", ".join(f"{k} {t}" for k, (t, _) in values.items())
    row = tuple(v for _, v in values.values())
    return spark.createDataFrame([row], schema).select(column).first()[0]


def test_finite_turns_nan_and_infinity_into_missing(spark):
    df = spark.createDataFrame(
        [(1.5,), (float("nan"),), (math.inf,), (-math.inf,), (None,)], "x double")
    assert [r[0] for r in df.select(X.finite(F.col("x"))).collect()] == [1.5] + [None] * 4


def test_clip_keeps_missing_missing(spark):
    df = spark.createDataFrame([(None,), (-9.0,), (9.0,), (8.0,), (0.5,)], "x double")
    got = [r[0] for r in df.select(X.clip(F.col("x"), -8.0, 8.0)).collect()]
    assert got == [None, -8.0, 8.0, 8.0, 0.5]


@pytest.mark.parametrize("n,quartiles,x,expected", [
    (1, [3.0, 3.0, 3.0], 3.0, None),
    (0, None, None, None),
    (5, [2.0, 2.0, 2.0], 7.0, 0.0),
    (5, [2.0, 2.0, 2.0], None, 0.0),
    (5, [1.0, 2.0, 3.7], None, None),
    (5, [1.0, 2.0, 3.7], 4.0, 2.0 / (2.7 / 1.35)),
    (None, None, 1.0, None),
])
def test_robust_z_rules(spark, n, quartiles, x, expected):
    got = one(spark, X.robust_z(F.col("x"), F.col("n"), F.col("q")),
              x=("double", x), n=("bigint", n), q=("array<double>", quartiles))
    assert got == (expected if expected is None else pytest.approx(expected, abs=1e-12))


@pytest.mark.parametrize("own,peer,expected", [
    (2.0, 4.0, 3.0), (2.0, None, 2.0), (None, 4.0, 4.0), (None, None, None),
    (20.0, 2.0, 8.0), (-30.0, 2.0, -8.0), (None, -9.0, -8.0), (8.0, 8.0, 8.0), (12.0, 0.0, 6.0),
])
def test_blend_four_ways(spark, own, peer, expected):
    got = one(spark, X.blend(F.col("h"), F.col("p")), h=("double", own), p=("double", peer))
    assert got == expected


def test_mean_abs_present(spark):
    cols = [F.col(c) for c in "abc"]
    df = spark.createDataFrame(
        [(1.0, -3.0, None), (None, None, None), (0.0, 0.0, -6.0)], "a double, b double, c double")
    rows = df.select(X.mean_abs_present(cols), X.count_present(cols)).collect()
    assert [tuple(r) for r in rows] == [(2.0, 2), (None, 0), (2.0, 3)]


def test_largest_by_magnitude_breaks_ties_by_position(spark):
    df = spark.createDataFrame(
        [(1.0, -2.0, 2.0, None), (None, None, None, None)], "a double, b double, c double, d double")
    best = X.largest_by_magnitude([(c, F.col(c)) for c in "abcd"], 3)
    rows = [[(e["name"], e["value"]) for e in r[0]] for r in df.select(best).collect()]
    assert rows == [[("b", -2.0), ("c", 2.0), ("a", 1.0)], []]


@pytest.mark.parametrize("value,text", [
    (8.0, "far above baseline (8.0)"), (-8.0, "far below baseline (-8.0)"),
    (0.0005, "above baseline (0.0005)"), (-1.25, "below baseline (-1.25)"),
    (0.0, "below baseline (0.0)"), (7.9999, "above baseline (7.9999)"),
    (1.23456, "above baseline (1.2346)"), (3.0, "above baseline (3.0)"),
])
def test_driver_label(spark, value, text):
    assert one(spark, X.driver_label(F.col("v")), v=("double", value)) == text


def test_safe_name(spark):
    df = spark.createDataFrame([("Rev Growth%",), ("2yr",), ("ok_1",), ("",), ("é.x",)], "n string")
    assert [r[0] for r in df.select(X.safe_name(F.col("n"))).collect()] == [
        "rev_growth_", "f_2yr", "ok_1", "", "__x"]


def test_calendar_quarter_and_list(spark):
    assert one(spark, X.calendar_quarter(F.col("d")), d=("string", "2024-11-30")) == "2024Q4"
    assert one(spark, X.split_list(F.col("s")), s=("string", "AAPL, MSFT ,X")) == ["AAPL", "MSFT", "X"]


def test_total_of_is_the_sum(spark):
    terms = [F.lit(float(i)) for i in range(7)]
    assert spark.range(1).select(X.total_of(terms)).first()[0] == 21.0


@pytest.mark.parametrize("prob,df,known", [
    (0.5, 1, 0.454936), (0.5, 2, 1.386294), (0.5, 5, 4.351460), (0.975, 1, 5.023886),
    (0.975, 5, 12.832502), (0.975, 30, 46.979242), (0.975, 100, 129.561197),
])
def test_chi2_quantiles_of_published_tables(prob, df, known):
    assert chi2_quantile(prob, df) == pytest.approx(known, abs=2e-6)
    assert chi2_cdf(chi2_quantile(prob, df), df) == pytest.approx(prob, abs=1e-12)
