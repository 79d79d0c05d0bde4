"""Tail probabilities and quantiles as column expressions.

They are attached to one-row results, so they cost nothing at scale; the continued fraction of the
incomplete beta function is folded with ``aggregate`` over a short index sequence.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lanczos coefficients (g = 7, n = 9) of the log-gamma approximation.
LANCZOS = [
    0.99999999999980993,
    676.5203681218851,
    -1259.1392167224028,
    771.32342877765313,
    -176.61502916214059,
    12.507343278686905,
    -0.13857109526572012,
    9.9843695780195716e-6,
    1.5056327351493116e-7,
]

FRACTION_STEPS = 300
BISECTION_STEPS = 60


def _lanczos_series(z: Column) -> Column:
    series = F.lit(LANCZOS[0])
    for k, c in enumerate(LANCZOS[1:], start=1):
        series = series + F.lit(c) / (z + float(k))
    return series


def log_gamma(x: Column) -> Column:
    """ln Γ(x) for x > 0."""
    z = x - 1.0
    t = z + 7.5
    return F.lit(0.5 * math.log(2 * math.pi)) + (z + 0.5) * F.log(t) - t + F.log(_lanczos_series(z))


def log_gamma_step(x: Column, by: Column) -> Column:
    """ln Γ(x + by) - ln Γ(x), written as one difference: the two terms cancel nearly all digits where x is large."""
    z = x - 1.0
    t = z + 7.5
    series = F.log(_lanczos_series(z + by) / _lanczos_series(z))
    return (z + 0.5) * F.log1p(by / t) + by * F.log(t + by) - by + series


def _beta_fraction(x: Column, rest: Column, a: Column, b: Column) -> Column:
    """Continued fraction of the incomplete beta function, both terms of a step taken together (modified Lentz evaluation).

    ``rest`` is 1 - x; only it enters where x is close to 1. The state carries c and d of the last step and the value h
    before it, so that no expression is repeated inside a step.
    """
    tiny = 1e-300

    def away_from_zero(v: Column) -> Column:
        return F.coalesce(F.nullif(v, F.lit(0.0)), F.lit(tiny))

    def state(c: Column, d: Column, h: Column) -> Column:
        return F.struct(c.alias("c"), d.alias("d"), h.alias("h"))

    lead = a * rest - b * x + 1.0

    def step(acc: Column, k: Column) -> Column:
        n = k.cast("double")
        twice = a + n * 2.0
        top = (a + n - 1.0) * (a + b + n - 1.0) / (twice - 1.0) * n * (b - n) / (twice - 1.0) * x * x
        level = n + n * (b - n) * x / (twice - 1.0) + (a + n) * (lead + n * (rest + 1.0)) / (twice + 1.0)
        return state(
            away_from_zero(level + top / acc["c"]),
            F.lit(1.0) / away_from_zero(level + top * acc["d"]),
            acc["h"] * acc["c"] * acc["d"],
        )

    start = state(F.lit(1.0 / tiny), F.lit(1.0) / away_from_zero(a * lead / (a + 1.0)), F.lit(tiny))
    steps = F.sequence(F.lit(1), F.lit(FRACTION_STEPS))
    return F.aggregate(steps, start, step, lambda acc: acc["h"] * acc["c"] * acc["d"])


def incomplete_beta(x: Column, a: Column, b: Column, rest: Column | None = None) -> Column:
    """Regularised incomplete beta function I_x(a, b). ``rest`` is 1 - x where the caller knows it better than by
    subtraction, which matters where x is close to 1 and ``a`` is large."""
    rest = F.lit(1.0) - x if rest is None else rest
    log_x = F.when(x < 0.5, F.log(x)).otherwise(F.log1p(-rest))
    log_rest = F.when(x < 0.5, F.log1p(-x)).otherwise(F.log(rest))
    front = F.exp(log_gamma_step(a, b) - log_gamma(b) + a * log_x + b * log_rest)
    low = front * _beta_fraction(x, rest, a, b)
    high = F.lit(1.0) - front * _beta_fraction(rest, x, b, a)
    inside = F.when(x < (a + 1.0) / (a + b + 2.0), low).otherwise(high)
    return F.when(x <= 0, F.lit(0.0)).when(rest <= 0, F.lit(1.0)).otherwise(inside)


def t_two_sided(t: Column, df: Column) -> Column:
    """P(|T| > |t|) of Student's t with ``df`` degrees of freedom: one incomplete beta function for every df. The terms
    of its fraction tend to those of the normal tail as df grows, so their number need not grow with df."""
    nu, square = df.cast("double"), t * t
    return incomplete_beta(nu / (nu + square), nu / 2.0, F.lit(0.5), square / (nu + square))


def chi2_two_df_upper(x: Column) -> Column:
    """P(X > x) for two degrees of freedom, where it is a plain exponential."""
    return F.exp(-x / 2.0)


def normal_two_sided(z: Column) -> Column:
    """P(|Z| > |z|) by a Chebyshev fit of the complementary error function."""
    u = F.abs(z) / math.sqrt(2.0)
    t = F.lit(1.0) / (F.lit(1.0) + u * 0.5)
    # Coefficients of the rational Chebyshev fit of erfc (fractional error below 1.2e-7).
    fit = F.lit(0.17087277)
    for c in (-0.82215223, 1.48851587, -1.13520398, 0.27886807, -0.18628806, 0.09678418, 0.37409196, 1.00002368, -1.26551223):
        fit = fit * t + c
    return t * F.exp(-u * u + fit)


def t_critical(df: Column, level: float = 0.95) -> Column:
    """The t value whose two-sided tail is ``1 - level``, by bisection."""
    tail = 1.0 - level

    def halve(acc: Column, _: Column) -> Column:
        mid = (acc["lo"] + acc["hi"]) / 2.0
        right = t_two_sided(mid, df) > tail
        return F.struct(
            F.when(right, mid).otherwise(acc["lo"]).alias("lo"),
            F.when(right, acc["hi"]).otherwise(mid).alias("hi"),
        )

    start = F.struct(F.lit(0.0).alias("lo"), F.lit(1000.0).alias("hi"))
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(BISECTION_STEPS)), start, halve, lambda acc: (acc["lo"] + acc["hi"]) / 2.0
    )
