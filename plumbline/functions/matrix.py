"""Small matrix helpers used inside tasks.

They travel to the workers by value, so the package need not be installed there.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle


def squared_distances(rows: np.ndarray, location: np.ndarray, whiten: np.ndarray) -> np.ndarray:
    white = (rows - location) @ whiten.T
    return np.einsum("ij,ij->i", white, white)


def whitening(covariance: np.ndarray) -> tuple[np.ndarray, float]:
    """Square root of the pseudo-inverse, and the log determinant (-inf when singular).

    Works on the correlation scale, so features measured in very different units all count.
    """
    spread = np.sqrt(np.clip(np.diag(covariance), 0.0, None))
    varies = spread > 0
    scale = np.where(varies, spread, 1.0)
    values, vectors = np.linalg.eigh(covariance / np.outer(scale, scale))
    kept = values > max(values.max(initial=0.0), 0.0) * len(values) * np.finfo(float).eps
    whiten = vectors[:, kept].T / np.sqrt(values[kept])[:, None] / scale
    if not kept.all() or not varies.all():
        return whiten, float("-inf")
    return whiten, float(np.log(values).sum() + 2 * np.log(scale).sum())


def moments(rows: np.ndarray, copies: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and covariance of rows that count ``copies`` times each."""
    total = copies.sum()
    location = copies @ rows / total
    centred = rows - location
    return location, (centred * copies[:, None]).T @ centred / total


def concentrate(rows: np.ndarray, copies: np.ndarray, subset: np.ndarray, h: float, steps: int):
    """Concentration steps inside one bucket; returns (logdet, location, covariance).

    Each step keeps the nearest rows, h copies of them in all. Only such subsets are compared: the
    starting subset is smaller and its determinant says nothing about theirs.
    """
    location, covariance = moments(rows[subset], copies[subset])
    best = None
    for _ in range(steps):
        whiten, _ = whitening(covariance)
        nearest = np.argsort(squared_distances(rows, location, whiten), kind="stable")
        upto = np.cumsum(copies[nearest])
        kept = np.clip(h - (upto - copies[nearest]), 0.0, copies[nearest])
        inside = kept > 0
        location, covariance = moments(rows[nearest[inside]], kept[inside])
        logdet = whitening(covariance)[1]
        if best is not None and logdet >= best[0]:
            break
        best = (logdet, location, covariance)
        if logdet == float("-inf"):
            break
    return best


cloudpickle.register_pickle_by_value(sys.modules[__name__])
