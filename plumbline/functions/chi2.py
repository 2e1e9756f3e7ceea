"""Chi-square quantiles, used for two cut-offs per fit on the driver."""

from __future__ import annotations

import math


def chi2_cdf(x: float, df: int) -> float:
    """P(df/2, x/2) by the power series of the regularised lower incomplete gamma function."""
    if x <= 0:
        return 0.0
    a, t = df / 2.0, x / 2.0
    term = total = 1.0 / a
    k = a
    while abs(term) > abs(total) * 1e-17:
        k += 1.0
        term *= t / k
        total += term
    return min(1.0, total * math.exp(a * math.log(t) - t - math.lgamma(a)))


def chi2_quantile(prob: float, df: int) -> float:
    low, high = 0.0, float(max(1, df))
    while chi2_cdf(high, df) < prob:
        low, high = high, high * 2
    for _ in range(200):
        mid = (low + high) / 2
        if mid in (low, high):
            break
        low, high = (mid, high) if chi2_cdf(mid, df) < prob else (low, mid)
    return (low + high) / 2
