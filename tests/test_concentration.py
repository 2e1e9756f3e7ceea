"""The one-scan step against sorting all rows: any guess, ties, narrow limits and partitionings."""

import numpy as np
import pytest

from plumbline.functions.matrix import squared_distances, whitening
from plumbline.operators import concentration
from plumbline.operators.concentration import moments_within, nearest_moments


def frame(spark, values, parts):
    return spark.createDataFrame(
        [tuple(map(float, v)) for v in values], ", ".join(f"f{i} double" for i in range(values.shape[1]))
    ).repartition(parts)


def by_sorting(values, centre, whiten, h):
    d = squared_distances(values, centre, whiten)
    cut = np.sort(d)[h - 1]
    inside = values[d <= cut * (1 + 1e-12)]
    return cut, inside.mean(axis=0), np.cov(inside.T, bias=True)


@pytest.fixture(scope="module")
def values():
    rng = np.random.default_rng(1)
    made = rng.normal(size=(4000, 3)) @ np.array([[1.0, 0.3, 0], [0, 2.0, 0.1], [0, 0, 0.5]])
    made[:900] = made[5]  # many rows at one distance
    made[900:1000] += 50
    return made


def shapes(values):
    out = []
    for rows in (values[1500:1600], values, values[950:1400]):
        out.append((rows.mean(axis=0), whitening(np.cov(rows.T))[0]))
    return out


@pytest.mark.parametrize("h", [900, 3000, 4000])
@pytest.mark.parametrize("read_rows", [20_000, 50])
def test_equals_sorting_for_good_bad_and_missing_guesses(spark, values, h, read_rows):
    df, starts = frame(spark, values, 5), shapes(values)
    wanted = [by_sorting(values, *s, h) for s in starts]
    cuts = [cut for cut, *_ in wanted]
    for guesses in ([(cuts[0], 1e3), (cuts[1] * 1.02, 50.0), (cuts[2] * 0.99, 0.0)],
                    [(0.0, 0.0), (cuts[1] * 100, 1.0), (float("nan"), 0.0)]):
        found = nearest_moments(df, starts, h, guesses, read_rows)
        for f, (cut, location, covariance) in zip(found, wanted):
            assert f.cut == pytest.approx(cut, rel=1e-9)
            np.testing.assert_allclose(f.location, location, rtol=1e-8, atol=1e-10)
            np.testing.assert_allclose(f.covariance, covariance, rtol=1e-7, atol=1e-9)


def test_a_close_guess_needs_one_scan_and_no_second_look(spark, values, monkeypatch):
    df, (start, *_) = frame(spark, values[1000:], 3), shapes(values)
    cut, *_ = by_sorting(values[1000:], *start, 2000)
    first = nearest_moments(df, [start], 2000, [(cut * 1.01, 0.0)])[0]
    monkeypatch.setattr(concentration, "_rows_between", None)
    again = nearest_moments(df, [start], 2000, [(first.cut * 1.001, first.density)])[0]
    assert again.cut == first.cut
    np.testing.assert_allclose(again.covariance, first.covariance, rtol=1e-12)


def test_rows_that_travel_along_are_limited(spark, values, monkeypatch):
    """All rows at one distance: far more of them than a scan may carry."""
    monkeypatch.setattr(concentration, "NEAR_ROWS", 4)
    same = np.concatenate([values[:900], values[1000:1200]])
    df, (start, *_) = frame(spark, same, 4), shapes(values)
    cut, location, _ = by_sorting(same, *start, 500)
    found = nearest_moments(df, [start], 500, [(cut, 100.0)], read_rows=10)[0]
    assert found.cut == pytest.approx(cut)
    np.testing.assert_allclose(found.location, location, atol=1e-9)


def test_moments_within_is_strict(spark):
    values = np.array([[0.0, 0.0], [1.0, 0.0], [0.0, 2.0], [3.0, 0.0]])
    found = moments_within(frame(spark, values, 2), np.zeros(2), np.eye(2), 4.0)
    np.testing.assert_allclose(found.location, [0.5, 0.0])
    np.testing.assert_allclose(found.covariance, [[0.25, 0.0], [0.0, 0.0]])


def test_steps_in_one_task_are_those_of_the_scans(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(6000, 4))
    x[:600] += 6
    df = spark.createDataFrame(x.tolist(), "a double, b double, c double, d double").repartition(5)
    n, h, p = len(x), 4500, 4
    whiten, logdet = whitening(np.cov(x.T))
    shape, guess, density, scans = (x.mean(axis=0), whiten, logdet), 0.0, 0.0, []
    for _ in range(60):
        found = nearest_moments(df, [shape[:2]], h, [(guess, density)])[0]
        whiten, logdet = whitening(found.covariance)
        if logdet >= shape[2] - 1e-12 * abs(shape[2]):
            break
        shape, guess, density = (found.location, whiten, logdet), found.cut, found.density
        scans.append(shape)
    start, first = scans[0], nearest_moments(df, [scans[0][:2]], h, [(0.0, 0.0)])[0]
    near = first.density or 500.0
    for cells in (n * p, 3000 * p, 600 * p):  # all rows, and bands that must be taken again
        location, whiten, logdet, cut, rate, taken, rounds = *start, first.cut, near, 0, 0
        while True:
            walk = concentration.steps_around(df, location, whiten, logdet, h, n, cut, rate, cells)
            assert walk is not None and (walk.taken or walk.done)
            taken, rounds = taken + walk.taken, rounds + 1
            if walk.taken:
                location, logdet, cut, rate = walk.location, walk.logdet, walk.cut, walk.density
                whiten = whitening(walk.covariance)[0]
            if walk.done:
                break
        assert taken == len(scans) - 1 and rounds <= taken + 1
        np.testing.assert_allclose(location, scans[-1][0], rtol=0, atol=1e-9)
        assert abs(logdet - scans[-1][2]) < 1e-9 and (cells < n * p or rounds == 1)
    assert concentration.steps_around(df, *start, h, n, first.cut * 50, near, 600 * p) is None
