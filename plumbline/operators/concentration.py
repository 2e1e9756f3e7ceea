"""Concentration steps over all rows: the h rows nearest to a shape, and their moments, from one scan.

A scan sums count, features and products of the rows in zones of the distance: below a bracket around the
expected cut, and in its bins. Zones add up over partitions, so the bin that holds the h-th row and the
moments of all nearer rows are known at once, for several shapes together. Only that bin is looked at
again: its rows are few and are read, or, where they are many, it becomes the next bracket. A narrow bin
around the last cut sends its rows along with the scan, so that steps near the fixed point need no second
one. A histogram over the bits of the distances finds the h-th row where a bracket missed it.

Near the fixed point a step moves few rows across the cut, so one task takes many (`steps_around`): it holds
the rows in a band around the cut and the moments of all nearer ones, and goes on as long as bounds on how
far any distance can have changed prove that no row outside the band has crossed the cut. The steps are the
same as those by scans.

The driver holds the zones' moments and the rows of one bin per shape, both bounded by parameters.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.matrix import squared_distances, whitening

# Bins of a bracket, and moments over all shapes and bins that the driver may receive.
BINS = 16
MOMENT_VALUES = 200_000
# The bracket reaches from guess / REACH to guess * REACH.
REACH = 1.6
# Rows of one bin that are read rather than narrowed, and that travel with a scan.
READ_ROWS = 20_000
NEAR_ROWS = 2_000
# Eight bins an octave: the leading bits of a double.
_OCTAVE_SHIFT = 49
# A bracket narrows sixteenfold, or ends at rows of one distance.
MAX_SCANS = 60
_TIE = 1.0 + 1e-12

_ZONES = "fit int, zone int, place int, amount double, lo double, hi double, near array<array<double>>"


@dataclass
class _Search:
    """What is known on the way to the h-th row of one shape."""

    centre: np.ndarray
    whiten: np.ndarray
    edges: np.ndarray
    near: int  # the zone whose rows travel along, 0 for none
    base: np.ndarray  # count, sums and products of the rows below the bracket, once it is narrowed
    narrowed: bool = False
    cut: float | None = None
    density: float = 0.0
    total: np.ndarray = field(default_factory=lambda: np.zeros(0))


@dataclass(frozen=True)
class Nearest:
    """Mean and covariance of the nearest rows, the distance of the last, and rows per unit around it."""

    location: np.ndarray
    covariance: np.ndarray
    cut: float
    density: float


def bracket(guess: float, density: float, bins: int) -> tuple[np.ndarray, int]:
    """Edges of zones around an expected cut, and the number of the zone that holds about NEAR_ROWS rows."""
    if not (0 < guess < math.inf):
        return np.array([0.0, np.finfo(float).max]), 0
    edges = np.geomspace(guess / REACH, guess * REACH, bins + 1)
    if density <= 0:
        return edges, 0
    half = min(NEAR_ROWS / density / 2, guess * (REACH - 1) / 2)
    lo, hi = guess - half, guess + half
    edges = np.unique(np.concatenate((edges[(edges < lo) | (edges > hi)], [lo, hi])))
    return edges, int(np.searchsorted(edges, lo, side="right"))


def _scan(fits: Sequence[tuple], cap: int, around: np.ndarray | None = None):
    """Zone sums of a partition; see ``_ZONES``. Place 0 is the count, -1 the bits' histogram.

    Products are taken around each shape's centre, or around another given place.
    """
    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = lows = None
        octaves = [{} for _ in fits]
        near = [[] for _ in fits]
        for batch in batches:
            x = batch.to_numpy(dtype=float)
            upper = np.triu_indices(x.shape[1])
            if sums is None:
                sums = [np.zeros((len(f[2]), 1 + x.shape[1] + len(upper[0]))) for f in fits]
                lows = [np.full((len(f[2]), 2), [math.inf, -math.inf]) for f in fits]
            for k, (centre, whiten, edges, near_zone, narrowed) in enumerate(fits):
                d = squared_distances(x, centre, whiten)
                zone = np.searchsorted(edges, d, side="right")
                values, often = np.unique(d.view(np.int64) >> _OCTAVE_SHIFT, return_counts=True)
                for v, n in zip(values.tolist(), often.tolist()):
                    octaves[k][v] = octaves[k].get(v, 0) + n
                for z in np.unique(zone):
                    if z == len(edges) or (z == 0 and narrowed):
                        continue
                    inside = zone == z
                    part = x[inside] - (centre if around is None else around)
                    sums[k][z, 0] += len(part)
                    sums[k][z, 1:1 + x.shape[1]] += part.sum(axis=0)
                    sums[k][z, 1 + x.shape[1]:] += (part.T @ part)[upper]
                    lows[k][z] = min(lows[k][z, 0], d[inside].min()), max(lows[k][z, 1], d[inside].max())
                    if z == near_zone and z:
                        held = sum(map(len, near[k]))
                        near[k].append(np.column_stack((d[inside], part))[:max(0, cap + 1 - held)])
        for k in range(len(fits) if sums is not None else 0):
            zones = np.flatnonzero(sums[k][:, 0])
            width = sums[k].shape[1]
            yield pd.DataFrame({
                "fit": k, "zone": np.repeat(zones, width), "place": np.tile(np.arange(width), len(zones)),
                "amount": sums[k][zones].ravel(), "lo": np.repeat(lows[k][zones, 0], width),
                "hi": np.repeat(lows[k][zones, 1], width), "near": None})
            yield pd.DataFrame({"fit": k, "zone": list(octaves[k]), "place": -1,
                                "amount": [float(n) for n in octaves[k].values()],
                                "lo": None, "hi": None, "near": None})
            rows = np.concatenate(near[k]) if near[k] else np.zeros((0, 0))
            if 0 < len(rows) <= cap:
                yield pd.DataFrame({"fit": [k], "zone": [0], "place": [-2], "amount": [float(len(rows))],
                                    "lo": [None], "hi": [None], "near": [rows.tolist()]})
    return scan


def _rows_between(fits: Sequence[tuple]):
    """(fit, distance, features around the centre) of the rows in each fit's bin."""
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = batch.to_numpy(dtype=float)
            for k, centre, whiten, lo, hi in fits:
                d = squared_distances(x, centre, whiten)
                inside = (d >= lo) & (d < hi)
                if inside.any():
                    yield pd.DataFrame({"fit": k, "row": np.column_stack((d[inside], x[inside] - centre)).tolist()})
    return read


def _last_of(rows: np.ndarray, wanted: int) -> tuple[float, np.ndarray]:
    """Distance of the wanted-th of some rows, and the moments of it, all nearer ones and its equals."""
    cut = np.partition(rows[:, 0], wanted - 1)[wanted - 1]
    inside = rows[rows[:, 0] <= cut * _TIE, 1:]
    upper = np.triu_indices(inside.shape[1])
    return float(cut), np.concatenate(([len(inside)], inside.sum(axis=0), (inside.T @ inside)[upper]))


def nearest_moments(
    rows: DataFrame, shapes: Sequence[tuple[np.ndarray, np.ndarray]], h: int,
    guesses: Sequence[tuple[float, float]], read_rows: int = READ_ROWS,
) -> list[Nearest]:
    """Moments of the h rows nearest to each (location, whitening matrix); equals of the h-th count too.

    ``rows`` has the features and nothing else, complete and in the shapes' order, h of them at least.
    ``guesses`` are expected cuts and rows per unit of distance around them (0: not known); they decide how
    often rows are read, not what comes out.
    """
    p = len(rows.columns)
    width = 1 + p + p * (p + 1) // 2
    bins = max(1, min(BINS, MOMENT_VALUES // (width * len(shapes)) - 3))
    n_partitions = rows.rdd.getNumPartitions()
    cap = -(-8 * NEAR_ROWS // n_partitions) if n_partitions <= 8 * NEAR_ROWS else 0
    searches = []
    for (centre, whiten), (guess, density) in zip(shapes, guesses):
        edges, near = bracket(guess, density if cap else 0.0, bins)
        searches.append(_Search(centre, whiten, edges, near, np.zeros(width)))
    for _ in range(MAX_SCANS):
        open_ = [s for s in searches if s.cut is None]
        if not open_:
            break
        _narrow(rows, open_, h, bins, width, cap, read_rows)
    else:
        raise RuntimeError(f"no cut found in {MAX_SCANS} scans")
    return [_nearest(s, p) for s in searches]


def moments_within(rows: DataFrame, centre: np.ndarray, whiten: np.ndarray, cut: float) -> Nearest:
    """Moments of the rows strictly nearer than ``cut``, of which there are some.

    Summed twice, the second time around the mean found first, which takes most of the rounding out.
    """
    p = len(rows.columns)
    around = centre
    for _ in range(2):
        found = rows.mapInPandas(_scan([(centre, whiten, np.array([cut]), 0, False)], 0, around), _ZONES) \
            .where(F.col("place") >= 0).groupBy("place").agg(F.sum("amount").alias("amount")).toPandas()
        total = np.zeros(1 + p + p * (p + 1) // 2)
        total[found["place"]] = found["amount"]
        nearest = _nearest(_Search(around, whiten, np.zeros(0), 0, total, cut=cut, total=total), p)
        around = nearest.location
    return nearest


def _nearest(search: _Search, p: int) -> Nearest:
    n, shift = search.total[0], search.total[1:1 + p] / search.total[0]
    products = np.zeros((p, p))
    products[np.triu_indices(p)] = search.total[1 + p:]
    products = products + np.triu(products, 1).T
    return Nearest(search.centre + shift, products / n - np.outer(shift, shift), search.cut, search.density)


def settled_in_task(
    rows: DataFrame, starts: Sequence[tuple[np.ndarray, np.ndarray]], h: int, steps: int,
) -> tuple[np.ndarray, np.ndarray, int]:
    """Location, covariance and steps of the fixed point for a table that one task may hold.

    Every start (location, covariance) takes ``steps`` steps; the one with the least determinant goes on
    until a step does not lower it. The caller has checked the size of ``rows``.
    """
    p, columns = len(rows.columns), rows.columns

    def settle(table: pd.DataFrame) -> pd.DataFrame:
        x = table[columns].sort_values(columns).to_numpy(dtype=float)

        def step(shape):
            location, covariance, _, done = shape
            d = squared_distances(x, location, whitening(covariance)[0])
            inside = x[d <= np.partition(d, h - 1)[h - 1] * _TIE]
            location = inside.mean(axis=0)
            centred = inside - location
            covariance = centred.T @ centred / len(inside)
            return location, covariance, whitening(covariance)[1], done + 1

        shapes = [(location, covariance, math.inf, 0) for location, covariance in starts]
        for _ in range(steps):
            shapes = [step(s) for s in shapes]
        best = min(shapes, key=lambda s: s[2])
        while best[2] > -math.inf:
            following = step(best)
            if following[2] >= best[2] - 1e-12 * max(1.0, abs(best[2])):
                break
            best = following
        return pd.DataFrame({"location": [best[0].tolist()], "covariance": [best[1].ravel().tolist()],
                             "steps": [best[3]]})

    found = rows.groupBy().applyInPandas(
        settle, "location array<double>, covariance array<double>, steps int").first()
    return np.asarray(found["location"]), np.asarray(found["covariance"]).reshape(p, p), found["steps"]


@dataclass(frozen=True)
class Walk:
    """Where some steps ended: the shape, its log determinant, the steps taken, the cut to be expected next
    and the rows per unit around it, and whether a further step would not lower the determinant."""

    location: np.ndarray
    covariance: np.ndarray | None
    logdet: float
    taken: int
    cut: float
    density: float
    done: bool


def _none_crossed(centre, whiten, lo: float, hi: float, location, now, cut: float) -> bool:
    """Whether rows nearer than ``lo`` by the first shape are surely within ``cut`` by the second, and those
    from ``hi`` on surely beyond it."""
    change = now @ np.linalg.inv(whiten)
    stretch = np.linalg.svd(change, compute_uv=False)
    shift = float(np.linalg.norm(now @ (centre - location)))
    edge = math.sqrt(cut * _TIE) * (1 + 1e-9)
    inner = lo <= 0 or stretch[0] * math.sqrt(lo) + shift < math.sqrt(cut) * (1 - 1e-9)
    return inner and (hi == math.inf or stretch[-1] * math.sqrt(hi) - shift > edge)


def steps_around(
    rows: DataFrame, centre: np.ndarray, whiten: np.ndarray, logdet: float, h: int, n_rows: int,
    guess: float, density: float, cells: int,
) -> Walk | None:
    """Steps from a shape of full rank by one task, with the rows around the expected cut, ``cells`` numbers at
    most; None if the cut is not known well enough for that. Takes one step at least."""
    p, columns = len(rows.columns), rows.columns
    most, width = cells // p, 1 + p + p * (p + 1) // 2
    lo, hi, base = -1.0, math.inf, np.zeros(width)
    if n_rows > most:
        if not (0 < guess < math.inf) or not density > 0:
            return None
        half = 0.35 * most / density
        for _ in range(4):
            lo, hi = guess - half, guess + half
            lo = lo if lo > 0 else -1.0
            found = rows.mapInPandas(_scan([(centre, whiten, np.array([lo, hi]), 0, False)], 0), _ZONES) \
                .where(F.col("place") >= 0).groupBy("zone", "place").agg(F.sum("amount").alias("amount")).toPandas()
            zones = np.zeros((2, width))
            zones[found["zone"], found["place"]] = found["amount"]
            base, held = zones[0], int(zones[1, 0])
            if not base[0] < h <= base[0] + held:
                return None
            if held <= most:
                break
            half *= 0.8 * most / held
        else:
            return None
    wanted = h - int(base[0])

    def band(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            d = squared_distances(batch.to_numpy(dtype=float), centre, whiten)
            yield batch[(d >= lo) & (d < hi)]

    def walk(table: pd.DataFrame) -> pd.DataFrame:
        x = table[columns].to_numpy(dtype=float)
        x = x[np.lexsort((*x.T[:3], squared_distances(x, centre, whiten)))]
        upper = np.triu_indices(p)
        location, now, best, covariance, taken, done = centre, whiten, logdet, None, 0, False
        while True:
            d = squared_distances(x, location, now)
            cut = float(np.partition(d, wanted - 1)[wanted - 1])
            if taken and not _none_crossed(centre, whiten, lo, hi, location, now, cut):
                break
            inside = x[d <= cut * _TIE] - centre
            total = base + np.concatenate(([len(inside)], inside.sum(axis=0), (inside.T @ inside)[upper]))
            nearest = _nearest(_Search(centre, whiten, np.zeros(0), 0, total, cut=cut, total=total), p)
            following, lower = whitening(nearest.covariance)
            if lower >= best - 1e-12 * max(1.0, abs(best)):
                done = True
                break
            location, now, best, covariance = nearest.location, following, lower, nearest.covariance
            taken += 1
            if best == -math.inf:
                done = True
                break
        around = max(1, int(((d >= cut * 0.99) & (d <= cut * 1.01)).sum())) / max(0.02 * cut, 1e-300)
        return pd.DataFrame({
            "location": [location.tolist()], "covariance": [None if covariance is None else covariance.ravel().tolist()],
            "logdet": [best], "taken": [taken], "cut": [cut], "density": [around], "done": [done]})

    schema = "location array<double>, covariance array<double>, logdet double, taken int, cut double, density double, done boolean"
    r = rows.mapInPandas(band, rows.schema).groupBy().applyInPandas(walk, schema).first()
    covariance = None if r["covariance"] is None else np.asarray(r["covariance"]).reshape(p, p)
    return Walk(np.asarray(r["location"]), covariance, r["logdet"], r["taken"], r["cut"], r["density"], r["done"])


def _narrow(rows: DataFrame, searches: list[_Search], h: int, bins: int, width: int, cap: int,
            read_rows: int) -> None:
    """One scan for all searches, and one more for those whose bin is small enough to be read."""
    fits = [(s.centre, s.whiten, s.edges, s.near, s.narrowed) for s in searches]
    found = rows.mapInPandas(_scan(fits, cap), _ZONES).groupBy("fit", "zone", "place").agg(
        F.sum("amount").alias("amount"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.flatten(F.collect_list("near")).alias("near")).toPandas()
    to_read = []
    for k, s in enumerate(searches):
        mine = found[found["fit"] == k]
        zones = mine[mine["place"] >= 0]
        sums = np.zeros((len(s.edges) + 1, width))
        sums[zones["zone"], zones["place"]] = zones["amount"]
        reached = s.base[0] + np.cumsum(sums[:len(s.edges), 0])
        z = int(np.searchsorted(reached, h - 0.5))
        if z == len(s.edges) or (z == 0 and not s.narrowed):
            _start_over(s, mine[mine["place"] == -1], h, bins)
            continue
        below = s.base + sums[:z].sum(axis=0)
        wanted, here = h - int(below[0]), int(sums[z, 0])
        extent = zones[(zones["zone"] == z) & (zones["place"] == 0)]
        lo, hi = float(extent["lo"].iloc[0]), float(extent["hi"].iloc[0])
        s.density = here / max(hi - lo, 1e-300)
        if wanted == here or lo == hi:
            s.cut, s.total = hi, below + sums[z]
            continue
        carried = mine[mine["place"] == -2]["near"]
        if z == s.near and len(carried) and len(carried.iloc[0]) == here:
            s.cut, last = _last_of(np.array([list(r) for r in carried.iloc[0]]), wanted)
            s.total = below + last
        elif here <= read_rows:
            to_read.append((s, below, wanted, (s.centre, s.whiten, s.edges[z - 1], s.edges[z])))
        else:
            # Edges at least one double apart, from the least to just above the greatest distance.
            ends = np.array([lo, np.nextafter(hi, math.inf)]).view(np.int64)
            steps = np.unique(np.linspace(0, int(ends[1] - ends[0]), bins + 2).astype(np.int64))
            s.edges, s.near, s.base, s.narrowed = (ends[0] + steps).view(float), 0, below, True
    if to_read:
        read = rows.mapInPandas(_rows_between([(k, *fit) for k, (*_, fit) in enumerate(to_read)]),
                                "fit int, row array<double>").toPandas()
        for k, (s, below, wanted, _) in enumerate(to_read):
            s.cut, last = _last_of(np.array(read.loc[read["fit"] == k, "row"].tolist()), wanted)
            s.total = below + last


def _start_over(search: _Search, octaves: pd.DataFrame, h: int, bins: int) -> None:
    """A new bracket where the histogram over all rows has the h-th."""
    octaves = octaves.sort_values("zone")
    at = int(np.searchsorted(np.cumsum(octaves["amount"].to_numpy()), h - 0.5))
    first = int(octaves["zone"].iloc[min(at, len(octaves) - 1)])
    ends = np.array([first << _OCTAVE_SHIFT, (first + 1) << _OCTAVE_SHIFT], np.int64)
    steps = np.unique(np.linspace(0, int(ends[1] - ends[0]), bins + 1).astype(np.int64))
    search.edges, search.near = (ends[0] + steps).view(float), 0
    if search.edges[0] == 0.0:  # below it would be nothing, and the first zone is not read
        search.edges = np.concatenate(([-1.0], search.edges[1:]))


cloudpickle.register_pickle_by_value(sys.modules[__name__])
