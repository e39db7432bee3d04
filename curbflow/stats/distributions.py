"""Quantiles of scalars, Student t and normal, for the width of intervals; tails of columns are in functions/tails."""

from __future__ import annotations

import math
from statistics import NormalDist

_NORMAL = NormalDist()
_TINY = 1e-300


def _continued_fraction(term, limit: int = 500, tolerance: float = 1e-15) -> float:
    """Evaluate b0 + a1/(b1 + a2/(b2 + ...)) by Lentz's method; term(k) gives (a_k, b_k)."""
    _, b0 = term(0)
    value = b0 or _TINY
    c, d = value, 0.0
    for k in range(1, limit):
        a, b = term(k)
        d = 1.0 / ((b + a * d) or _TINY)
        c = (b + a / c) or _TINY
        step = c * d
        value *= step
        if abs(step - 1.0) < tolerance:
            break
    return value


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0.0 or x >= 1.0:
        return float(x >= 1.0)
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - incomplete_beta(b, a, 1.0 - x)
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )

    def term(k: int) -> tuple[float, float]:
        if k == 0:
            return 0.0, 1.0
        m, odd = divmod(k, 2)
        if odd:
            return -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)), 1.0
        return m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), 1.0

    return front / (a * _continued_fraction(term))


def t_two_sided(t: float, df: float) -> float:
    """P(|T| > |t|)."""
    if math.isnan(t):
        return math.nan
    return incomplete_beta(df / 2.0, 0.5, df / (df + t * t))


def t_quantile(probability: float, df: float) -> float:
    """Upper quantile (probability above one half) by bisection on the tail."""
    tail = 2.0 * (1.0 - probability)
    low, high = 0.0, 1.0
    while t_two_sided(high, df) > tail:
        high *= 2.0
    for _ in range(200):
        middle = (low + high) / 2.0
        low, high = (middle, high) if t_two_sided(middle, df) > tail else (low, middle)
    return (low + high) / 2.0


def normal_quantile(probability: float) -> float:
    return _NORMAL.inv_cdf(probability)
