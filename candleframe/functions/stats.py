"""Statistics as Spark expressions: guarded correlation, Student-t p-value."""

from __future__ import annotations

import math
from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def guarded_corr(x, y) -> Column:
    """Pearson correlation over rows where both x and y are non-NULL (an aggregate).

    ``covar_pop / (stddev_pop * stddev_pop)`` with ``try_divide``: a constant series or a
    single observation gives NULL instead of the DIVIDE_BY_ZERO that ``F.corr`` raises under
    ANSI. All three aggregates are algebraic, so they combine map-side before the shuffle.
    """
    x, y = _c(x), _c(y)
    both = x.isNotNull() & y.isNotNull()
    xx, yy = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(xx, yy), F.stddev_pop(xx) * F.stddev_pop(yy))


def pair_count(x, y) -> Column:
    """Number of rows where both x and y are non-NULL (an aggregate)."""
    x, y = _c(x), _c(y)
    return F.count(F.when(x.isNotNull() & y.isNotNull(), F.lit(1)))


def clip(value, lo: float, hi: float) -> Column:
    """Clip to [lo, hi]; NULL stays NULL (unlike greatest/least, which skip NULL)."""
    v = _c(value)
    return F.when(v > hi, F.lit(hi)).when(v < lo, F.lit(lo)).otherwise(v)


#: Arguments of the asymptotic gamma ratio are shifted above this (its error is then below 1e-10).
_SHIFT = 24


def _gamma_ratio(a) -> Column:
    """Gamma(a + 1/2) / Gamma(a) for a > 0: recurrence up to a + _SHIFT, then its asymptotic series."""
    z = a + _SHIFT
    tail = F.sqrt(z) * (
        1 - 1 / (8 * z) + 1 / (128 * z * z) + 5 / (1024 * z * z * z) - 21 / (32768 * z * z * z * z)
    )
    for k in range(_SHIFT):
        tail = tail * ((a + k) / (a + (k + 0.5)))
    return tail


def _beta_fraction(x, a, b) -> Column:
    """Continued fraction of the incomplete beta function (converges fast for x < (a+1)/(a+b+2)).

    Steed's forward evaluation by ``aggregate`` over a ``sequence`` whose length grows with
    sqrt(max(a, b)), as the number of terms needed does.
    """
    tiny = 1e-300
    steps = F.sequence(F.lit(1), (40 + 6 * F.sqrt(F.greatest(a, b))).cast("int"))

    def safe(v):
        return F.when(F.abs(v) < tiny, F.lit(tiny)).otherwise(v)

    d0 = 1 / safe(1 - (a + b) * x / (a + 1))

    def step(acc, m):
        m = m.cast("double")
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1 / safe(1 + even * acc["d"])
        c = safe(1 + even / acc["c"])
        h = acc["h"] * d * c
        d2 = 1 / safe(1 + odd * d)
        c2 = safe(1 + odd / c)
        return F.struct(c2.alias("c"), d2.alias("d"), (h * d2 * c2).alias("h"))

    start = F.struct(F.lit(1.0).alias("c"), d0.alias("d"), d0.alias("h"))
    return F.aggregate(steps, start, step, lambda acc: acc["h"])


def student_t_two_sided_p(r, n) -> Column:
    """Two-sided p-value of a correlation ``r`` over ``n`` observations (t test, n-2 df).

    p = I_x(v/2, 1/2) with v = n - 2 and x = 1 - r^2, the regularized incomplete beta
    function: by its continued fraction where that converges fast (small p; the power is
    taken in log space, so tails keep their relative accuracy), else as the complement of
    I_(1-x)(1/2, v/2), where p is not small. NULL when n < 3 or r is NULL, 0 when |r| = 1.
    One row per correlation.
    """
    r, n = _c(r), _c(n).cast("double")
    a = F.greatest(n - 2, F.lit(1.0)) / 2
    inner = F.abs(r) < 1
    y = F.when(inner, r * r).otherwise(F.lit(0.5))
    x = F.when(inner, (1 - F.abs(r)) * (1 + F.abs(r))).otherwise(F.lit(0.5))
    # 1 / B(a, 1/2) = Gamma(a + 1/2) / (Gamma(a) sqrt(pi))
    front = F.exp(a * F.ln(x)) * F.sqrt(y) * _gamma_ratio(a) / math.sqrt(math.pi)
    half = F.lit(0.5)
    p = F.when(x < (a + 1) / (a + 2.5), front * _beta_fraction(x, a, half) / a).otherwise(
        1 - front * _beta_fraction(y, half, a) / half
    )
    return (
        F.when(_c(r).isNull() | (n < 3), F.lit(None).cast("double"))
        .when(~inner, F.lit(0.0))
        .otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), p)))
    )
