"""Tail probabilities and quantiles for a handful of summary numbers.

Applied to rows that are already aggregated, one per metric or date. The normal
law comes from the standard library; Student's t and Fisher's F go through the
regularised incomplete beta function in its continued-fraction form.
"""

from __future__ import annotations

import math
from statistics import NormalDist

NORMAL = NormalDist()


def normal_tail(z: float) -> float:
    """P(Z > z)."""
    return 0.5 * math.erfc(z / math.sqrt(2.0))


def _beta_fraction(a: float, b: float, x: float) -> float:
    tiny = 1e-300

    def safe(v: float) -> float:
        return v if abs(v) > tiny else tiny

    c, d = 1.0, 1.0 / safe(1.0 - (a + b) * x / (a + 1.0))
    value = d
    for m in range(1, 100_000):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for term in (even, odd):
            d = 1.0 / safe(1.0 + term * d)
            c = safe(1.0 + term / c)
            value *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return value


def beta_share(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
        + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


# Beyond these many degrees of freedom the series around the normal law is
# closer than the fraction above (error below 1e-12).
_TAIL_SERIES = 1e6
_QUANTILE_SERIES = 1e4


def t_two_sided(t: float, df: float) -> float:
    """P(|T| > |t|)."""
    if math.isnan(t) or math.isnan(df):
        return math.nan
    if math.isinf(t):
        return 0.0
    if df > _TAIL_SERIES:
        z = abs(t) * (1.0 - 1.0 / (4.0 * df)) / math.sqrt(1.0 + t * t / (2.0 * df))
        return 2.0 * normal_tail(z)
    return beta_share(df / 2.0, 0.5, df / (df + t * t))


def t_quantile(p: float, df: float) -> float:
    """The t with P(T <= t) = p."""
    if p == 0.5:
        return 0.0
    if df > _QUANTILE_SERIES:
        z = NORMAL.inv_cdf(p)
        return z + (z**3 + z) / (4 * df) + (5 * z**5 + 16 * z**3 + 3 * z) / (96 * df * df)
    wanted = 2.0 * min(p, 1.0 - p)
    low, high = 0.0, 1.0
    while t_two_sided(high, df) > wanted:
        high *= 2.0
    for _ in range(200):
        mid = (low + high) / 2.0
        if mid in (low, high):
            break
        low, high = (mid, high) if t_two_sided(mid, df) > wanted else (low, mid)
    root = (low + high) / 2.0
    return root if p > 0.5 else -root


def f_tail_one(value: float, df: float) -> float:
    """P(F > value) with 1 and ``df`` degrees of freedom (F is then a squared t)."""
    return t_two_sided(math.sqrt(value), df)
