"""Tail probabilities against published table values."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymart.functions import distributions as dist


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "t, df, p",
    [(12.706, 1, 0.05), (2.228, 10, 0.05), (2.750, 30, 0.01), (-2.228, 10, 0.05), (1.984, 100, 0.05), (1.646, 1000, 0.1), (1.96, 50000, 0.05)],
)
def test_t_tail(spark, t, df, p):
    assert value(spark, dist.t_two_sided(F.lit(t), F.lit(df))) == pytest.approx(p, rel=2e-3)


def integrated_tail(t, df, cells=400_000):
    """Twice the integral of the density beyond t, by Simpson's rule after x = t + u / (1 - u)."""
    u = np.linspace(0, 1, cells + 1)[:-1]
    x = t + u / (1 - u)
    logs = math.lgamma((df + 1) / 2) - math.lgamma(df / 2) - 0.5 * math.log(df * math.pi)
    y = np.append(np.exp(logs - (df + 1) / 2 * np.log1p(x * x / df)) / (1 - u) ** 2, 0.0)
    return 2 / cells / 3 * (y[0] + y[-1] + 4 * y[1:-1:2].sum() + 2 * y[2:-1:2].sum())


@pytest.mark.parametrize("t", [0.3, 1.0, 1.7, 1.8, 2.5, 6.0])
@pytest.mark.parametrize("df", [3, 40, 1999, 2000, 2001, 60_000])
def test_t_tail_is_the_integral_of_the_density(spark, t, df):
    assert value(spark, dist.t_two_sided(F.lit(t), F.lit(df))) == pytest.approx(integrated_tail(t, df), rel=2e-9)


def test_t_tail_falls_smoothly_and_ends_at_the_normal(spark):
    tails = [value(spark, dist.t_two_sided(F.lit(2.5), F.lit(df))) for df in (1999, 2000, 2001, 2002)]
    steps = [a - b for a, b in zip(tails, tails[1:])]
    assert steps == pytest.approx([steps[0]] * 3, rel=5e-3) and steps[0] > 0
    for t in (0.5, 1.96, 5.0):
        assert value(spark, dist.t_two_sided(F.lit(t), F.lit(10**12))) == pytest.approx(math.erfc(t / math.sqrt(2)), rel=1e-9)


@pytest.mark.parametrize("df, q", [(1, 12.7062), (5, 2.5706), (60, 2.0003), (100000, 1.95999)])
def test_t_critical(spark, df, q):
    assert value(spark, dist.t_critical(F.lit(df))) == pytest.approx(q, rel=1e-4)


def test_normal_and_chi2(spark):
    assert value(spark, dist.normal_two_sided(F.lit(1.959964))) == pytest.approx(0.05, rel=1e-5)
    assert value(spark, dist.chi2_two_df_upper(F.lit(5.991465))) == pytest.approx(0.05, rel=1e-5)


def test_log_gamma(spark):
    assert value(spark, dist.log_gamma(F.lit(5.0))) == pytest.approx(3.1780538303479458, rel=1e-12)
    assert value(spark, dist.log_gamma(F.lit(0.5))) == pytest.approx(0.5723649429247001, rel=1e-12)
