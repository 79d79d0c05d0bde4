"""Hypothesis tests. Statistics come from one aggregate each; tail probabilities are attached to the
one-row result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.functions import distributions as dist
from tallymart.operators.relational import tie_ranks
from tallymart.operators.skew import one_row


def _one_sample(df: DataFrame, value: Column, against: float) -> DataFrame:
    sums = df.select(value.cast("double").alias("v")).agg(
        F.count("v").alias("n"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("sd")
    )
    t = F.try_divide(F.col("mean") - against, F.try_divide(F.col("sd"), F.sqrt("n")))
    return sums.select("n", "mean", t.alias("t"), (F.col("n") - 1).alias("df"))


def ttest_1samp(df: DataFrame, value: str, against: float = 0.0) -> DataFrame:
    return _one_sample(df, F.col(value), against)


def ttest_rel(df: DataFrame, first: str, second: str) -> DataFrame:
    """Paired test; a row counts only when both values are there."""
    return _one_sample(df, F.col(first) - F.col(second), 0.0)


def ttest_ind(df: DataFrame, group: str, value: str, first, second) -> DataFrame:
    """Two groups with pooled variance."""
    sums = one_row(
        df.agg(
            *(
                agg(F.when(F.col(group) == level, F.col(value))).alias(f"{name}{i}")
                for i, level in enumerate((first, second), start=1)
                for name, agg in (("n", F.count), ("mean", F.avg), ("var", F.var_samp))
            )
        )
    )
    row = df.sparkSession.range(1).select(sums.alias("s")).select("s.*")
    df_all = F.col("n1") + F.col("n2") - 2
    pooled = ((F.col("n1") - 1) * F.col("var1") + (F.col("n2") - 1) * F.col("var2")) / df_all
    t = (F.col("mean1") - F.col("mean2")) / F.sqrt(pooled * (1 / F.col("n1") + 1 / F.col("n2")))
    return row.select("n1", "n2", t.alias("t"), df_all.alias("df"))


def with_t_p_value(result: DataFrame) -> DataFrame:
    return result.withColumn("p", dist.t_two_sided(F.col("t"), F.col("df")))


def wilcoxon(df: DataFrame, first: str, second: str) -> DataFrame:
    """Signed-rank statistic: zero differences dropped, ties averaged, normal approximation.

    Ranks are needed once per distinct |difference|; the signs are counted per distinct value, so no
    row is ranked on its own.
    """
    d = F.col(first).cast("double") - F.col(second).cast("double")
    rows = df.select(d.alias("d")).filter(F.col("d") != 0).select(
        F.abs("d").alias("size"), (F.col("d") > 0).cast("long").alias("up")
    )
    sums = tie_ranks(rows, "size", up=F.sum("up")).agg(
        F.sum("ties").alias("n"),
        F.sum(F.col("up") * F.col("avg_rank")).alias("w_plus"),
        F.sum((F.col("ties") - F.col("up")) * F.col("avg_rank")).alias("w_minus"),
        F.sum(F.pow(F.col("ties"), F.lit(3)) - F.col("ties")).alias("tied"),
    )
    n = F.col("n").cast("double")
    w = F.least("w_plus", "w_minus")
    variance = n * (n + 1) * (2 * n + 1) / 24 - F.col("tied") / 48
    return sums.select("n", w.alias("w"), ((w - n * (n + 1) / 4) / F.sqrt(variance)).alias("z"))


def jarque_bera(moment_row: DataFrame) -> DataFrame:
    jb = F.col("n") / 6 * (F.pow("skewness", F.lit(2)) + F.pow(F.col("kurtosis") - 3, F.lit(2)) / 4)
    return moment_row.select("n", "skewness", "kurtosis", jb.alias("jb")).withColumn(
        "p", dist.chi2_two_df_upper(F.col("jb"))
    )


def omnibus(moment_row: DataFrame) -> DataFrame:
    """D'Agostino-Pearson K2 from the transformed skewness and kurtosis (needs at least 8 rows)."""
    n = F.col("n").cast("double")
    skew, kurt = F.col("skewness"), F.col("kurtosis")
    # skewness -> normal score
    y = skew * F.sqrt((n + 1) * (n + 3) / (6 * (n - 2)))
    beta = 3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = F.sqrt(2 * (beta - 1)) - 1
    delta = 1 / F.sqrt(0.5 * F.log(w2))
    alpha = F.sqrt(2 / (w2 - 1))
    z_skew = delta * F.log(y / alpha + F.sqrt(F.pow(y / alpha, F.lit(2)) + 1))
    # kurtosis -> normal score
    centre = 3 * (n - 1) / (n + 1)
    spread = 24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))
    x = (kurt - centre) / F.sqrt(spread)
    third = 6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * F.sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    a = 6 + 8 / third * (2 / third + F.sqrt(1 + 4 / (third * third)))
    ratio = (1 - 2 / a) / (1 + x * F.sqrt(2 / (a - 4)))
    z_kurt = (1 - 2 / (9 * a) - F.signum(ratio) * F.pow(F.abs(ratio), F.lit(1 / 3))) / F.sqrt(2 / (9 * a))
    return (
        moment_row.select("n", z_skew.alias("z_skewness"), z_kurt.alias("z_kurtosis"))
        .withColumn("k2", F.col("z_skewness") * F.col("z_skewness") + F.col("z_kurtosis") * F.col("z_kurtosis"))
        .withColumn("p", dist.chi2_two_df_upper(F.col("k2")))
    )
