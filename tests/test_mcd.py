import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.operators import mcd
from plumbline.operators.mcd import robust_mahalanobis

P = ["a", "b", "c"]
MIX = np.array([[1.0, 0.4, 0.0], [0.0, 1.0, -0.3], [0.2, 0.0, 0.5]])


def frame(spark, values, parts=3):
    rows = [(i, *map(float, v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "id int, " + ", ".join(f"{c} double" for c in P)).repartition(parts)


def distances(df, **options):
    rows = robust_mahalanobis(df, P, **options).select("id", "mahalanobis_distance").collect()
    return np.array([r[1] for r in sorted(rows)])


@pytest.fixture(scope="module")
def clean():
    return np.random.default_rng(3).normal(size=(3000, 3)) @ MIX


@pytest.fixture(scope="module")
def planted(clean):
    """15 % of the rows moved far away."""
    values = clean.copy()
    values[:450] = values[:450] * 0.1 + np.array([40.0, -30.0, 25.0])
    return values


def test_planted_outliers_separate(spark, planted):
    d2 = distances(frame(spark, planted))
    assert (d2 >= 0).all()
    assert d2[:450].min() > 20 * d2[450:].max()


def test_close_to_classical_distance_on_clean_data(spark, clean):
    centred = clean - clean.mean(axis=0)
    classical = np.einsum("ij,jk,ik->i", centred, np.linalg.inv(np.cov(clean.T)), centred)
    d2 = distances(frame(spark, clean))
    assert np.corrcoef(d2, classical)[0, 1] > 0.999
    assert 0.9 < np.median(d2) / np.median(classical) < 1.2


def test_same_result_for_any_partitioning_and_again(spark, planted):
    first = distances(frame(spark, planted, 1))
    np.testing.assert_allclose(distances(frame(spark, planted, 7)), first, rtol=1e-9)
    np.testing.assert_allclose(distances(frame(spark, planted, 1)), first, rtol=1e-9)


def test_units_do_not_matter(spark, planted):
    """Affine invariance, with units eight orders of magnitude apart."""
    first = distances(frame(spark, planted))
    scaled = planted * np.array([1e6, 1e-2, 3.0]) + np.array([5.0, -7.0, 1e3])
    np.testing.assert_allclose(distances(frame(spark, scaled)), first, rtol=1e-6)


def test_every_row_takes_part_in_the_starts(spark, planted, monkeypatch):
    """Many small buckets find the same optimum as one."""
    first = distances(frame(spark, planted))
    monkeypatch.setattr(mcd, "BUCKET_ROWS", 150)
    np.testing.assert_allclose(distances(frame(spark, planted), cells=500), first, rtol=1e-6)


def test_other_columns_have_no_say(spark, planted):
    df = frame(spark, planted)
    named = df.withColumn("name", F.concat(F.lit("row "), F.col("id").cast("string")))
    np.testing.assert_allclose(distances(named), distances(df), rtol=1e-9)


def test_copies_of_one_row_are_one_point_of_the_starts(spark, clean):
    values = np.concatenate([clean[:900], np.repeat(clean[:1], 500, axis=0)])
    d2 = distances(frame(spark, values))
    assert np.isfinite(d2).all() and np.allclose(d2[900:], d2[0])


def test_the_optimum_of_few_rows_is_found(spark):
    """No subset of 15 of 20 rows has a smaller determinant than the one behind the distances."""
    from itertools import combinations
    values = np.random.default_rng(5).standard_t(2, size=(20, 2))
    df = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(values)], "id int, a double, b double")
    fitted = mcd.fit_shape(df, ["a", "b"], 20)
    best = min(combinations(range(20), 15), key=lambda pick: np.linalg.det(np.cov(values[list(pick)].T, bias=True)))
    location, cov = values[list(best)].mean(axis=0), np.cov(values[list(best)].T, bias=True)
    raw = np.einsum("ij,jk,ik->i", values - location, np.linalg.inv(cov), values - location)
    factor = np.median(raw) / mcd.chi2_quantile(0.5, 2)
    near = values[raw < factor * mcd.chi2_quantile(0.975, 2)]
    np.testing.assert_allclose(fitted.location, near.mean(axis=0), rtol=1e-6, atol=1e-9)


def test_missing_values_take_the_median(spark):
    values = np.random.default_rng(1).normal(size=(200, 3))
    filled = values.copy()
    values[:30, 1] = np.nan
    filled[:30, 1] = np.nanmedian(values[:, 1])
    df = frame(spark, values).select("id", *[F.nanvl(c, F.lit(None)).alias(c) for c in P])
    np.testing.assert_allclose(
        distances(df), distances(frame(spark, filled)), rtol=1e-6)


def test_too_few_rows_give_the_squared_norm(spark):
    df = frame(spark, np.array([[1.0, 2.0, 3.0], [4.0, 5.0, 6.0], [0.0, 1.0, 0.0]]))
    np.testing.assert_allclose(distances(df), [14.0, 77.0, 1.0])


def test_constant_and_missing_features_take_no_part(spark, clean):
    df = frame(spark, clean[:500])
    plain = distances(df)
    extra = df.select("*", F.lit(7.0).alias("k"), F.lit(None).cast("double").alias("m"))
    rows = robust_mahalanobis(extra, [*P, "k", "m"]).select("id", "mahalanobis_distance").collect()
    np.testing.assert_allclose([r[1] for r in sorted(rows)], plain, rtol=1e-6)


def test_duplicated_feature_is_tolerated(spark, clean):
    df = frame(spark, clean[:500]).withColumn("twin", F.col("a"))
    rows = robust_mahalanobis(df, [*P, "twin"]).select("mahalanobis_distance").collect()
    assert all(r[0] is not None and np.isfinite(r[0]) and r[0] >= 0 for r in rows)


def test_single_feature(spark, clean):
    df = frame(spark, clean[:400])
    rows = robust_mahalanobis(df, ["a"]).select("id", "a", "mahalanobis_distance").collect()
    a = np.array([r[1] for r in sorted(rows)])
    d2 = np.array([r[2] for r in sorted(rows)])
    assert np.argmin(d2) in np.argsort(np.abs(a - np.median(a)))[:60]
    assert d2.max() == d2[np.argmax(np.abs(a - a[np.argmin(d2)]))]


def test_worker_helpers_need_no_installed_package(tmp_path):
    """Workers unpickle the matrix helpers without being able to import this package."""
    import subprocess
    import sys

    from pyspark import cloudpickle
    from plumbline.functions.matrix import squared_distances

    def job(rows):
        return float(squared_distances(rows, rows[0], np.eye(2)).sum())

    saved = tmp_path / "job.pkl"
    saved.write_bytes(cloudpickle.dumps(job))
    code = ("import pickle, sys, numpy as np; f = pickle.load(open(sys.argv[1], 'rb')); "
            "print(f(np.array([[0.0, 0.0], [3.0, 4.0]])))")
    done = subprocess.run([sys.executable, "-c", code, str(saved)], cwd=tmp_path,
                          capture_output=True, text=True, check=True)
    assert done.stdout.strip() == "25.0"


@pytest.mark.parametrize("cells", [500_000, 100])
def test_one_task_and_many_scans_reach_the_same_fit(spark, planted, cells):
    """A small table settles in one task, a large one by scans; ties and copies included."""
    values = np.concatenate([planted, np.repeat(planted[700:702], 60, axis=0)])
    d2 = distances(frame(spark, values), cells=cells)
    np.testing.assert_allclose(d2, distances(frame(spark, values), cells=100), rtol=1e-9)
