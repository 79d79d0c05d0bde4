"""Least squares. One-predictor models are closed forms over one aggregate; models with several predictors are
solved from the co-moments of all columns (``gram``)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.functions import distributions as dist
from tallymart.operators.gram import LinearFit, grams
from tallymart.operators.ordering import lagged
from tallymart.operators.relational import contiguous_folds
from tallymart.operators.skew import one_row

# ---- one predictor ---------------------------------------------------------------------------


def _both(df: DataFrame, y: str, x: str) -> DataFrame:
    return df.filter(F.col(y).isNotNull() & F.col(x).isNotNull())


def simple_fit(df: DataFrame, y: str, x: str, group: list[str] | None = None) -> DataFrame:
    """n, centred sums of squares, slope, intercept and R2 of y on x, per group if asked."""
    sums = _both(df, y, x).groupBy(*(group or [])).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(x).alias("mean_x"),
        F.avg(y).alias("mean_y"),
        F.regr_sxx(F.col(y), F.col(x)).alias("sxx"),
        F.regr_syy(F.col(y), F.col(x)).alias("syy"),
        F.regr_sxy(F.col(y), F.col(x)).alias("sxy"),
    )
    slope = F.try_divide("sxy", "sxx")  # null for a constant x
    return (
        sums.withColumn("slope", slope)
        .withColumn("intercept", F.col("mean_y") - F.col("slope") * F.col("mean_x"))
        .withColumn("r2", F.try_divide(F.col("sxy") * F.col("sxy"), F.col("sxx") * F.col("syy")))
    )


def no_intercept_fit(df: DataFrame, y: str, x: str) -> DataFrame:
    """Slope of the line through the origin; null if x is 0 everywhere."""
    return _both(df, y, x).agg(
        F.count(F.lit(1)).alias("n"),
        F.try_divide(F.sum(F.col(x) * F.col(y)), F.sum(F.col(x) * F.col(x))).alias("slope"),
    )


def _with_errors(fit: DataFrame) -> DataFrame:
    """Residual sum of squares and its mean square on n - 2 degrees of freedom; null for a constant x, the latter also
    without degrees of freedom."""
    explained = F.try_divide(F.col("sxy") * F.col("sxy"), F.col("sxx"))
    ssr = F.when(explained.isNotNull(), F.greatest(F.col("syy") - explained, F.lit(0.0)))
    return fit.withColumn("ssr", ssr).withColumn("s2", F.try_divide("ssr", F.col("n") - 2))


def inference(fit: DataFrame, level: float = 0.95) -> DataFrame:
    """Standard errors, t values, p values and confidence limits of slope and intercept: two rows. What has a zero
    denominator (constant x, an exact fit's t) is null."""
    errors = _with_errors(fit)
    se_slope = F.sqrt(F.try_divide("s2", "sxx"))
    level_part = F.try_divide(F.lit(1.0), F.col("n")) + F.try_divide(F.col("mean_x") * F.col("mean_x"), F.col("sxx"))
    se_const = F.sqrt(F.col("s2") * level_part)
    terms = F.array(
        F.struct(F.lit("intercept").alias("term"), F.col("intercept").alias("coefficient"), se_const.alias("se")),
        F.struct(F.lit("slope").alias("term"), F.col("slope").alias("coefficient"), se_slope.alias("se")),
    )
    rows = errors.select("n", F.explode(terms).alias("r")).select("r.*", (F.col("n") - 2).alias("df"))
    rows = rows.withColumn("t", F.try_divide("coefficient", "se"))
    return (
        rows.withColumn("p", dist.t_two_sided(F.col("t"), F.col("df")))
        .withColumn("_q", dist.t_critical(F.col("df"), level))
        .withColumn("low", F.col("coefficient") - F.col("_q") * F.col("se"))
        .withColumn("high", F.col("coefficient") + F.col("_q") * F.col("se"))
        .drop("_q")
    )


def fstat_loglik(fit: DataFrame) -> DataFrame:
    """F statistic (one predictor) and log-likelihood in log form; null for a constant x or an exact fit."""
    n = F.col("n").cast("double")
    f = F.try_divide(F.col("syy") - F.col("ssr"), F.col("s2"))
    loglik = -n / 2 * (F.log(F.try_divide(F.lit(2 * math.pi) * F.col("ssr"), n)) + 1)
    return _with_errors(fit).select("n", f.alias("f"), loglik.alias("loglik")).withColumn(
        "p", dist.t_two_sided(F.sqrt("f"), F.col("n") - 2)
    )


def residuals(df: DataFrame, y: str, x: str) -> DataFrame:
    """Fitted value and residual beside every row; the coefficients are a one-row subquery."""
    fit = one_row(simple_fit(df, y, x).select("slope", "intercept"))
    placed = _both(df, y, x).withColumn("_fit", fit)
    fitted = F.col("_fit")["intercept"] + F.col("_fit")["slope"] * F.col(x)
    return placed.withColumn("fitted", fitted).withColumn("residual", F.col(y) - F.col("fitted")).drop("_fit")


def prediction_interval(df: DataFrame, y: str, x: str, level: float = 0.95) -> DataFrame:
    """Fitted value, standard error of a new observation and its limits, per row."""
    errors = _with_errors(simple_fit(df, y, x)).withColumn("q", dist.t_critical(F.col("n") - 2, level))
    fit = one_row(errors.select("n", "mean_x", "sxx", "slope", "intercept", "s2", "q"))
    f = F.col("_fit")
    off = F.col(x) - f["mean_x"]
    se = F.sqrt(f["s2"] * (1 + F.try_divide(F.lit(1.0), f["n"]) + F.try_divide(off * off, f["sxx"])))
    return (
        _both(df, y, x)
        .withColumn("_fit", fit)
        .withColumn("fitted", f["intercept"] + f["slope"] * F.col(x))
        .withColumn("se", se)
        .withColumn("low", F.col("fitted") - f["q"] * F.col("se"))
        .withColumn("high", F.col("fitted") + f["q"] * F.col("se"))
        .drop("_fit")
    )


def predict_new(fit: DataFrame, points: DataFrame, x: str) -> DataFrame:
    model = one_row(fit.select("slope", "intercept"))
    return points.withColumn("_fit", model).withColumn(
        "prediction", F.col("_fit")["intercept"] + F.col("_fit")["slope"] * F.col(x)
    ).drop("_fit")


def durbin_watson(df: DataFrame, residual: str, order: list[str]) -> DataFrame:
    """Sum of squared successive differences over the sum of squares, in a total row order; null if all are 0."""
    e, before = F.col(residual), F.col("_before")
    pairs = lagged(df.select(*order, residual), [F.col(c) for c in order], _before=residual)
    sums = pairs.agg(
        F.count(F.lit(1)).alias("n"), F.sum(e * e).alias("sse"), F.sum((e - before) * (e - before)).alias("change")
    )
    return sums.select("n", F.try_divide("change", "sse").alias("dw"))


def fit_without_last(df: DataFrame, y: str, x: str, order: list[str]) -> DataFrame:
    """R2 with every row and without the last one in ``order``: two rows."""
    keys = F.struct(*order)
    last = one_row(df.agg(F.max(keys).alias("key")))
    whole = simple_fit(df, y, x).select(F.lit("all").alias("rows_used"), "n", "r2")
    part = simple_fit(df.filter(keys != last["key"]), y, x).select(F.lit("without_last").alias("rows_used"), "n", "r2")
    return whole.unionByName(part)


def cv_rmse(df: DataFrame, y: str, x: str, order: list[Column], k: int = 10) -> DataFrame:
    """Pooled root mean squared error over k contiguous folds; null if some complement has a constant x.

    Each fold's model is fitted on the complement, whose sums are the totals less the fold's own, so
    one pass of sums serves all k fits. Values are shifted by the means first, against cancellation.
    """
    folds = contiguous_folds(df.select(*(c for c in df.columns)), order, k)
    centre = one_row(df.agg(F.avg(x).alias("x"), F.avg(y).alias("y")))
    placed = folds.withColumn("_c", centre).select(
        "fold", (F.col(x) - F.col("_c")["x"]).alias("u"), (F.col(y) - F.col("_c")["y"]).alias("v")
    )
    u, v = F.col("u"), F.col("v")
    sums = placed.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"), F.sum(u).alias("su"), F.sum(v).alias("sv"), F.sum(u * u).alias("suu"),
        F.sum(u * v).alias("suv"), F.sum(v * v).alias("svv"),
    )
    every = Window.partitionBy()  # k rows
    rest = {c: F.sum(c).over(every) - F.col(c) for c in ("n", "su", "sv", "suu", "suv")}
    models = sums.select("*", *(column.alias(f"r_{c}") for c, column in rest.items()))
    slope = F.try_divide(
        F.col("r_n") * F.col("r_suv") - F.col("r_su") * F.col("r_sv"), F.col("r_n") * F.col("r_suu") - F.col("r_su") * F.col("r_su")
    )
    models = models.withColumn("b", slope).withColumn("a", F.try_divide(F.col("r_sv") - F.col("b") * F.col("r_su"), F.col("r_n")))
    a, b = F.col("a"), F.col("b")
    # sum over the fold of (v - a - b u)^2
    sse = (
        F.col("svv") - 2 * a * F.col("sv") - 2 * b * F.col("suv")
        + F.col("n") * a * a + 2 * a * b * F.col("su") + b * b * F.col("suu")
    )
    return models.agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("folds"), F.when(F.count(sse) == F.count(F.lit(1)), F.sqrt(F.try_divide(F.sum(sse), F.sum("n")))).alias("rmse")
    )


def group_contrasts(df: DataFrame, group: str, value: str) -> DataFrame:
    """y ~ C(group): the intercept is the mean of the first level, each other coefficient the
    difference of its level's mean. One row per level, with the standard error of the coefficient;
    null where every level has one row."""
    levels = df.filter(F.col(group).isNotNull() & F.col(value).isNotNull()).groupBy(group).agg(
        F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"), F.var_pop(value).alias("var")
    )
    base = one_row(levels.agg(F.min_by(F.struct("n", "mean"), F.col(group)).alias("b"), F.min(group).alias("g")))
    total = one_row(
        levels.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("levels"), F.sum(F.col("n") * F.col("var")).alias("ssr"))
    )
    placed = levels.withColumn("_b", base).withColumn("_t", total)
    first = F.col(group) == F.col("_b")["g"]
    s2 = F.try_divide(F.col("_t")["ssr"], F.col("_t")["n"] - F.col("_t")["levels"])
    se = F.sqrt(s2 * (1 / F.col("n") + F.when(first, 0.0).otherwise(1 / F.col("_b")["b"]["n"])))
    coefficient = F.col("mean") - F.when(first, 0.0).otherwise(F.col("_b")["b"]["mean"])
    return placed.select(F.col(group).alias("level"), "n", coefficient.alias("coefficient"), se.alias("se"))


# ---- several predictors ----------------------------------------------------------------------


def fit_multi(df: DataFrame, y: str, predictors: list[str]) -> LinearFit:
    return grams(df, [y, *predictors]).of([y, *predictors]).fit(y, predictors)


def coefficient_table(df: DataFrame, model: LinearFit, predictors: list[str]) -> DataFrame:
    """Coefficient, standard error, t and p per term with the model's R2: one row per term. What has a zero
    denominator or no degrees of freedom is null."""

    def known(value: float) -> float | None:
        return float(value) if math.isfinite(value) else None

    values = [*model.coefficients.tolist(), model.intercept]
    rows = [
        (term, known(v), known(se), model.df, known(model.r2), known(model.r2_adj))
        for term, v, se in zip([*predictors, "intercept"], values, model.se.tolist())
    ]
    table = df.sparkSession.createDataFrame(
        rows, "term string, coefficient double, se double, df long, r2 double, r2_adj double"
    ).withColumn("t", F.try_divide("coefficient", "se"))
    p = F.when(F.col("df") > 0, dist.t_two_sided(F.col("t"), F.greatest("df", F.lit(1))))
    return table.select("term", "coefficient", "se", "t", p.alias("p"), "r2", "r2_adj")


def apply_multi(df: DataFrame, model: LinearFit, predictors: list[str], name: str) -> DataFrame:
    """Prediction as a plain expression of the predictors: no vector column is built."""
    out = F.lit(float(model.intercept))
    for column, weight in zip(predictors, model.coefficients.tolist()):
        out = out + F.lit(float(weight)) * F.col(column)
    return df.withColumn(name, out)


def partial_regression(df: DataFrame, y: str, predictors: list[str], keep: list[str]) -> DataFrame:
    """Per row and predictor: residuals of y and of the predictor on the other predictors, and the
    component plus residual of the full model. One scan serves all models; both residuals are expressions on the
    same row, so nothing is joined. Rows with a null in y or a predictor are left out."""
    moments = grams(df, [y, *predictors]).of([y, *predictors])
    full = moments.fit(y, predictors)
    rows = apply_multi(df.select(*keep, y, *predictors).na.drop(subset=[y, *predictors]), full, predictors, "_full")
    weights = dict(zip(predictors, full.coefficients.tolist()))
    parts = []
    for p in predictors:
        others = [c for c in predictors if c != p]
        rows = apply_multi(rows, moments.fit(y, others), others, f"_y_{p}")
        rows = apply_multi(rows, moments.fit(p, others), others, f"_x_{p}")
        parts.append(
            F.struct(
                F.lit(p).alias("predictor"),
                (F.col(y) - F.col(f"_y_{p}")).alias("y_residual"),
                (F.col(p) - F.col(f"_x_{p}")).alias("x_residual"),
                (F.lit(weights[p]) * F.col(p) + F.col(y) - F.col("_full")).alias("component_plus_residual"),
            )
        )
    return rows.select(*keep, F.explode(F.array(*parts)).alias("_p")).select(*keep, "_p.*")


def split_scores(
    train: DataFrame, test: DataFrame, y: str, models: dict[str, list[str]]
) -> DataFrame:
    """Train and test error of linear models on several predictor lists: one row per model, from one scan of each part.

    A model uses the rows that are complete in y and its own predictors; a part without such rows has a null error.
    """
    columns = [y, *dict.fromkeys(p for predictors in models.values() for p in predictors)]
    parts = [grams(part, columns) for part in (train, test)]
    rows = []
    for name, predictors in models.items():
        own = [part.of([y, *predictors]) for part in parts]
        model = own[0].fit(y, predictors)
        rows.append((name, *(part.mean_squared_error(model) for part in own)))
    out = train.sparkSession.createDataFrame(rows, "model string, train_mse double, test_mse double")
    return out.withColumn("train_rmse", F.sqrt("train_mse")).withColumn("test_rmse", F.sqrt("test_mse"))
