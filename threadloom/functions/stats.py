"""Tail of Student's t distribution, for the p-values of correlations, as column functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from threadloom.functions.vectors import let

# Steps of the continued fraction; sizes up to 10**8 need fewer.
FRACTION_STEPS = 800
# The ratio of gamma functions is taken this far up, where its series is exact to 13 digits.
GAMMA_SHIFT = 32
_TINY = 1e-300


def _off_zero(value: Column) -> Column:
    return let(value, lambda v: F.when(F.abs(v) < _TINY, _TINY).otherwise(v))


def beta_fraction(p: Column, q: Column, y: Column) -> Column:
    """Continued fraction of the incomplete beta function by Lentz's method, as a fold over its steps."""
    def numerator(j: Column) -> Column:
        m = F.floor(j / 2).cast("double")
        even = m * (q - m) * y / ((p + 2 * m - 1) * (p + 2 * m))
        odd = -(p + m) * (p + q + m) * y / ((p + 2 * m) * (p + 2 * m + 1))
        return F.when(j % 2 == 0, even).otherwise(odd)

    def step(state: Column, j: Column) -> Column:
        def go(a: Column) -> Column:
            d, c = 1 / _off_zero(1 + a * state["d"]), _off_zero(1 + a / state["c"])
            return let(F.struct(c.alias("c"), d.alias("d")), lambda s: F.struct(s["c"], s["d"], (state["f"] * s["c"] * s["d"]).alias("f")))

        return let(numerator(j), go)

    first = 1 / _off_zero(1 - (p + q) * y / (p + 1))
    start = F.struct(F.lit(1.0).alias("c"), first.alias("d"), first.alias("f"))
    return F.aggregate(F.sequence(F.lit(2), F.lit(FRACTION_STEPS)), start, step)["f"]


def _log_gamma_ratio(a: Column) -> Column:
    """ln of gamma(a + 1/2) / gamma(a): down from a + GAMMA_SHIFT, where the asymptotic series holds."""
    steps = F.sequence(F.lit(0), F.lit(GAMMA_SHIFT - 1))
    below = F.aggregate(steps, F.lit(0.0), lambda total, j: total + F.log((a + j) / (a + j + 0.5)))
    z = a + GAMMA_SHIFT
    series = 1 - 1 / (8 * z) + 1 / (128 * z * z) + 5 / (1024 * z * z * z) - 21 / (32768 * z * z * z * z)
    return below + F.log(z) / 2 + F.log(series)


def correlation_p(r: Column, n: Column) -> Column:
    """Two-sided p-value of a correlation coefficient over n pairs; NULL below three pairs or without r.

    It is the incomplete beta function of 1 - r**2 with parameters (n - 2) / 2 and 1/2, from the side on
    which its fraction converges.
    """
    def tail(s: Column) -> Column:
        a, x = s["a"], s["x"]
        front = F.exp(_log_gamma_ratio(a) - F.log(F.sqrt(F.pi())) + a * F.log(x) + F.log(1 - x) / 2)
        direct = x < (a + 1) / (a + 2.5)
        half = F.lit(0.5)
        near = F.when(direct, F.struct(a.alias("p"), half.alias("q"), x.alias("y"))).otherwise(
            F.struct(half.alias("p"), a.alias("q"), (1 - x).alias("y")))
        part = let(near, lambda t: front * beta_fraction(t["p"], t["q"], t["y"]) / t["p"])
        return F.when(direct, part).otherwise(1 - part)

    r, n = r.cast("double"), n.cast("double")
    inside = F.struct(((n - 2) / 2).alias("a"), (1 - r * r).alias("x"))
    return (
        F.when(r.isNull() | F.isnan(r) | n.isNull() | (n < 3), F.lit(None).cast("double"))
        .when(F.abs(r) >= 1, 0.0).when(r * r < 1e-300, 1.0).when(1 - r * r >= 1, 1.0)
        .otherwise(let(inside, tail))
    )
