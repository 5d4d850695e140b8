"""Expected normal scores of ranks and the Shapiro-Wilk test built on their sums.

Royston's published approximation (Applied Statistics algorithm R94): the weights
of the ordered sample come from the normal scores m_i = Phi^-1((i - 3/8) / (n +
1/4)), with the outermost two corrected. All that is needed of the sample is the
sum of m_i * x_(i), four outer order statistics and the sum of squares.

Scores are column expressions. The sum over a run of equal values is the integral of the score over the
run's ranks with two end corrections; only the outermost ``EDGE`` ranks at either end, where
the score is steep, are summed one by one. Either way the error is below 1e-11.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicklake.functions.tails import NORMAL, normal_tail

EDGE = 64

# Fixed values of algorithm AS 241 (normal quantile), lowest power first: numerator
# and denominator around the middle, further out, and in the tails.
MIDDLE = (
    (3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4,
     4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3),
    (1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3,
     2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3),
)
OUTER = (
    (1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0,
     1.27045825245236838258e0, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4),
    (1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
     1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9),
)
TAIL = (
    (6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0, 2.96560571828504891230e-1,
     2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7),
    (1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
     7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15),
)

# Fixed values of algorithm R94, lowest power first.
C1 = (0.0, 0.221157, -0.147981, -2.07119, 4.434685, -2.706056)
C2 = (0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633)
C3 = (0.544, -0.39978, 0.025054, -6.714e-4)
C4 = (1.3822, -0.77857, 0.062767, -0.0020322)
C5 = (-1.5861, -0.31082, -0.083751, 0.0038915)
C6 = (-0.4803, -0.082676, 0.0030302)
G = (-2.273, 0.459)


def _ratio(parts: tuple, x: Column) -> Column:
    sums = []
    for coefficients in parts:
        total = F.lit(coefficients[-1])
        for c in reversed(coefficients[:-1]):
            total = total * x + F.lit(c)
        sums.append(total)
    return sums[0] / sums[1]


def _quantile(p: Column, r: Column) -> Column:
    """The z with P(Z <= z) = p; r is the root of minus the logarithm of the smaller tail."""
    q = p - 0.5
    far = F.when(r <= 5, _ratio(OUTER, r - 1.6)).otherwise(_ratio(TAIL, r - 5))
    return F.when(F.abs(q) <= 0.425, q * _ratio(MIDDLE, 0.180625 - q * q)).otherwise(F.signum(q) * far)


def _tail_root(p: Column) -> Column:
    return F.sqrt(-F.ln(F.least(p, 1 - p)))


def with_normal_quantiles(df: DataFrame, shares: dict[str, Column]) -> DataFrame:
    """Add for each name the z with P(Z <= z) = its share, strictly between 0 and 1.

    In steps, so that what the formula uses often is a column and is computed once.
    """
    step = df.withColumns({f"_p_{n}": p for n, p in shares.items()})
    step = step.withColumns({f"_r_{n}": _tail_root(F.col(f"_p_{n}")) for n in shares})
    step = step.withColumns({n: _quantile(F.col(f"_p_{n}"), F.col(f"_r_{n}")) for n in shares})
    return step.drop(*[f"_{x}_{n}" for n in shares for x in "pr"])


def _one_by_one(low: Column, high: Column, n: Column) -> Column:
    """Sum of the scores of the ranks low .. high, one after the other."""
    shares = F.transform(F.sequence(low, high), lambda rank: (rank - 0.375) / (n + 0.25))
    known = F.transform(shares, lambda p: F.struct(p.alias("p"), _tail_root(p).alias("r")))
    terms = F.aggregate(known, F.lit(0.0), lambda total, x: total + _quantile(x["p"], x["r"]))
    return F.when(low <= high, terms).otherwise(F.lit(0.0))


def with_score_sums(df: DataFrame, runs: dict[str, tuple[Column, Column, Column]]) -> DataFrame:
    """Add for each name the sum of the scores of the ranks before + 1 .. upto out of n.

    ``runs`` has (before, upto, n) for each name; the sum over an empty run is 0.
    """
    shares, limits = {}, {}
    for name, (before, upto, n) in runs.items():
        low, high = F.greatest(before + 1, F.lit(EDGE + 1)), F.least(upto, n - EDGE)
        limits |= {f"_low_{name}": low, f"_high_{name}": high}
        # The score of a single rank; of more ranks those where the run begins and ends.
        low, high, width = F.col(f"_low_{name}"), F.col(f"_high_{name}"), n + 0.25
        shares[f"_a_{name}"] = F.when(low < high, low - 0.875).when(low == high, low - 0.375) / width
        shares[f"_b_{name}"] = F.when(low < high, high + 0.125) / width
    out = with_normal_quantiles(df.withColumns(limits), shares)
    sums = {}
    for name, (before, upto, n) in runs.items():
        width, low, high = n + 0.25, before + 1, upto
        a, b = F.col(f"_a_{name}"), F.col(f"_b_{name}")

        def density(z: Column) -> Column:
            return F.exp(-z * z / 2) / math.sqrt(2 * math.pi)

        def correction(z: Column, width: Column = width) -> Column:
            slope = 1 / (width * density(z))
            return 7 * slope * slope * slope * (1 + 2 * z * z) / 5760 - slope / 24

        smooth = width * (density(a) - density(b)) + correction(b) - correction(a)
        inside = F.coalesce(F.when(F.col(f"_low_{name}") == F.col(f"_high_{name}"), a).otherwise(smooth), F.lit(0.0))
        first = _one_by_one(low, F.least(high, F.lit(EDGE)), n)
        last = _one_by_one(F.greatest(low, n - EDGE + 1, F.lit(EDGE + 1)), high, n)
        sums[name] = F.when(low > high, F.lit(0.0)).when((low > EDGE) & (high <= n - EDGE), inside).otherwise(first + inside + last)
    return out.withColumns(sums).drop(*limits, *shares)


def _score(rank: float, n: float) -> float:
    return NORMAL.inv_cdf((rank - 0.375) / (n + 0.25))


def square_sum(n: float) -> float:
    """Sum of all squared scores of n ranks."""
    edge = min((int(n) + 1) // 2, 1000)
    total = 2 * sum(_score(i, n) ** 2 for i in range(1, edge + 1))  # the middle score of an odd n is 0
    if n > 2 * edge:
        width = n + 0.25
        a, b = _score(edge + 0.5, n), _score(n - edge + 0.5, n)
        total += width * ((NORMAL.cdf(b) - b * NORMAL.pdf(b)) - (NORMAL.cdf(a) - a * NORMAL.pdf(a)))
        total -= (2 * b / NORMAL.pdf(b) - 2 * a / NORMAL.pdf(a)) / (24 * width)
    return total


def _power_series(coefficients: tuple, x: float) -> float:
    return float(np.polynomial.polynomial.polyval(x, coefficients))


def shapiro_p(
    n: int, squares: float, scores: float, first: float, second: float,
    before_last: float, last: float,
) -> float:
    """p-value of the Shapiro-Wilk test; 0 where the test is undefined (n < 3).

    ``squares`` is the sum of squares around the mean, ``scores`` the sum of
    m_i * (x_(i) - mean).
    """
    if n < 3:
        return 0.0
    if not squares > 0:
        return 1.0
    if n == 3:
        weighted = math.sqrt(0.5) * (last - first)
    else:
        m1, m2, total = -_score(1, n), -_score(2, n), square_sum(float(n))
        root = 1.0 / math.sqrt(n)
        a1 = _power_series(C1, root) + m1 / math.sqrt(total)
        outer = m1 * (last - first)
        if n > 5:
            a2 = _power_series(C2, root) + m2 / math.sqrt(total)
            scale = math.sqrt(
                (total - 2 * m1 * m1 - 2 * m2 * m2) / (1 - 2 * a1 * a1 - 2 * a2 * a2)
            )
            outer += m2 * (before_last - second)
            weighted = a1 * (last - first) + a2 * (before_last - second)
        else:
            scale = math.sqrt((total - 2 * m1 * m1) / (1 - 2 * a1 * a1))
            weighted = a1 * (last - first)
        weighted += (scores - outer) / scale
    w = min(1.0, weighted * weighted / squares)
    if n == 3:
        p = 6 / math.pi * (math.asin(math.sqrt(w)) - math.asin(math.sqrt(0.75)))
        return max(0.0, p)
    if w >= 1.0:
        return 1.0
    y = math.log1p(-w)
    if n <= 11:
        bound = _power_series(G, n)
        if y >= bound:
            return 0.0
        y = -math.log(bound - y)
        centre, spread = _power_series(C3, n), math.exp(_power_series(C4, n))
    else:
        logn = math.log(n)
        centre, spread = _power_series(C5, logn), math.exp(_power_series(C6, logn))
    return normal_tail((y - centre) / spread)
