"""Tail probabilities as column expressions: incomplete beta and chi-square with one degree of freedom.

Built from Spark's own functions; sums and continued fractions are folds
(``aggregate`` over a ``sequence``), so they run wherever an expression runs. They
are meant for a handful of summary rows, not for wide tables.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TINY = 1e-300
BISECTIONS = 60

# The first terms of the Stirling series' error, n! against sqrt(2 pi n) (n / e)^n
_STIRLING = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188)


def _stirling_error(n: Column) -> Column:
    """ln n! minus its Stirling approximation, for n >= 1; below 16 from the factorial itself."""
    small = F.log(F.factorial(F.least(n, F.lit(15.0)).cast("int")).cast("double")) - (
        (n + 0.5) * F.log(n) - n + 0.9189385332046727)
    large = sum((F.lit(c) / F.pow(n, 2 * i + 1) for i, c in enumerate(_STIRLING)), F.lit(0.0))
    return F.when(n <= 15, small).otherwise(large)


def _deviance(x: Column, mean: Column) -> Column:
    """x ln(x / mean) + mean - x without loss for x near the mean."""
    d = (x - mean) / mean
    return mean * ((1 + d) * F.log1p(d) - d)


def log_binomial(k: Column, n: Column, p: Column) -> Column:
    """ln of the probability of k successes in n tries, for 0 < k < n and 0 < p < 1 (saddle-point form)."""
    return (_stirling_error(n) - _stirling_error(k) - _stirling_error(n - k) - _deviance(k, n * p)
            - _deviance(n - k, n * (1 - p)) + 0.5 * F.log(n / (F.lit(6.283185307179586) * k * (n - k))))


def _fraction(a: Column, b: Column, x: Column) -> Column:
    """Continued fraction of the incomplete beta (Lentz), for x below (a + 1) / (a + b + 2)."""
    def safe(c: Column) -> Column:
        return F.when(F.abs(c) < TINY, F.lit(TINY)).otherwise(c)
    # the terms needed grow with the root of the counts
    steps = F.sequence(F.lit(2), (F.lit(120) + F.lit(6.0) * F.sqrt(a + b)).cast("int"))
    first = F.lit(1.0) / safe(1 - (a + b) * x / (a + 1))

    def step(s: Column, i: Column) -> Column:
        # one term a step, so that no expression of a step is written out more than twice
        m = F.floor(i / 2).cast("double")
        term = F.when(i % 2 == 0, m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))).otherwise(
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)))
        d, c = F.lit(1.0) / safe(1 + term * s["d"]), safe(1 + term / s["c"])
        return F.struct(c.alias("c"), d.alias("d"), (s["h"] * d * c).alias("h"))
    start = F.struct(F.lit(1.0).alias("c"), first.alias("d"), first.alias("h"))
    return F.aggregate(steps, start, step, lambda s: s["h"])


def incomplete_beta(x: Column, a: Column, b: Column) -> Column:
    """I_x(a, b) for whole numbers a, b >= 1 given as DOUBLE and 0 <= x <= 1."""
    inner = F.least(F.greatest(x, F.lit(TINY)), F.lit(1 - 2.0**-53))
    front = F.exp(log_binomial(a, a + b, inner)) * a * b / (a + b)
    low = front * _fraction(a, b, inner) / a
    high = 1 - front * _fraction(b, a, 1 - inner) / b
    return F.when(x <= 0, 0.0).when(x >= 1, 1.0).when(inner < (a + 1) / (a + b + 2), low).otherwise(high)


def beta_quantile(p: float, a: Column, b: Column) -> Column:
    """x with I_x(a, b) = p, by bisection."""
    def half(s: Column, _: Column) -> Column:
        middle = (s["low"] + s["high"]) / 2
        below = incomplete_beta(middle, a, b) < p
        return F.struct(F.when(below, middle).otherwise(s["low"]).alias("low"),
                        F.when(below, s["high"]).otherwise(middle).alias("high"))
    start = F.struct(F.lit(0.0).alias("low"), F.lit(1.0).alias("high"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(BISECTIONS)), start, half, lambda s: (s["low"] + s["high"]) / 2)


def binomial_interval(k: Column, n: Column, level: float = 0.95) -> tuple[Column, Column]:
    """Exact two-sided interval of a share: k of n; ends at 0 and 1 for k = 0 and k = n; NULL for n = 0."""
    side = (1 - level) / 2
    # NULL where the bound is not taken from the quantile keeps the folds off undefined counts
    inner_low, inner_high = F.when(k > 0, k), F.when(k < n, k)
    low = F.when(k <= 0, 0.0).otherwise(beta_quantile(side, inner_low, n - inner_low + 1))
    high = F.when(k >= n, 1.0).otherwise(beta_quantile(1 - side, inner_high + 1, n - inner_high))
    return F.when(n > 0, low), F.when(n > 0, high)


def binomial_upper_tail(k: Column, n: Column, p: Column) -> Column:
    """Probability of k or more successes in n tries; NULL for n = 0."""
    inner = F.when(k > 0, k)
    return F.when(n > 0, F.when(k <= 0, 1.0).otherwise(incomplete_beta(p, inner, n - inner + 1)))


def chi_square_1_tail(x: Column) -> Column:
    """Probability that a chi-square variable with one degree of freedom is x or more."""
    h = x / 2
    # series of the lower incomplete gamma function of 1/2 for small x
    def term(s: Column, i: Column) -> Column:
        t = s["t"] * h / (i + 0.5)
        return F.struct(t.alias("t"), (s["sum"] + t).alias("sum"))
    total = F.aggregate(F.sequence(F.lit(1), F.lit(120)), F.struct(F.lit(2.0).alias("t"), F.lit(2.0).alias("sum")), term,
                        lambda s: s["sum"])
    small = 1 - total * F.exp(-h) * F.sqrt(h) / F.lit(1.7724538509055159)
    # continued fraction of the upper one for large x, from its last term inwards
    fraction = F.aggregate(F.sequence(F.lit(200), F.lit(1), F.lit(-1)), F.lit(0.0),
                           lambda s, i: i * (i - 0.5) / (h + 2 * i + 0.5 - s))
    large = F.exp(-h) * F.sqrt(h) / F.lit(1.7724538509055159) / (h + 0.5 - fraction)
    return F.when(x <= 0, 1.0).when(h < 3, small).otherwise(large)
