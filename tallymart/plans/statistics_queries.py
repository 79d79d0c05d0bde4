"""Hypothesis tests and regression over orders and line items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.operators import hypothesis_tests as tests
from tallymart.operators import regression as reg
from tallymart.operators import relational as rel
from tallymart.plans.registry import REG, query
from tallymart.plans.relational_queries import MOMENTS_SQL, ROW_ORDER
from tallymart.sources import tables

ORDER = tables.REGRESSION_ORDER
PREDICTORS = ["x1", "x2", "x3"]
PAIRED = "pa AS (SELECT o_totalprice / 1000 AS a, c_acctbal AS b FROM orders JOIN customer ON o_custkey = c_custkey)"


def _reg(spark: SparkSession, folder: str) -> DataFrame:
    return tables.regression_rows(spark, folder)


def _order() -> list:
    return [F.col(c) for c in ORDER]


def _rounded(df: DataFrame, places: int, *columns: str) -> DataFrame:
    return df.select(*(F.round(c, places).alias(c) if c in columns else F.col(c) for c in df.columns))


# ---- tests -----------------------------------------------------------------------------------


@query(
    "ttest_1samp",
    "SELECT count(*) AS n, round(avg(c_acctbal), 6) AS mean, round(avg(c_acctbal) / (stddev_samp(c_acctbal) / sqrt(count(*))), 8) AS t, "
    "count(*) - 1 AS df FROM customer",
)
def ttest_1samp(spark, folder):
    result = tests.ttest_1samp(tables.table(spark, folder, "customer"), "c_acctbal")
    return _rounded(_rounded(result, 6, "mean"), 8, "t")


@query(
    "ttest_ind",
    """WITH g AS (SELECT count(*) FILTER (o_orderstatus = 'O') AS n1, count(*) FILTER (o_orderstatus = 'F') AS n2,
      avg(o_totalprice) FILTER (o_orderstatus = 'O') AS m1, avg(o_totalprice) FILTER (o_orderstatus = 'F') AS m2,
      var_samp(o_totalprice) FILTER (o_orderstatus = 'O') AS v1, var_samp(o_totalprice) FILTER (o_orderstatus = 'F') AS v2 FROM orders)
    SELECT n1, n2, round((m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2) * (1 / n1 + 1 / n2)), 8) AS t,
      n1 + n2 - 2 AS df FROM g""",
)
def ttest_ind(spark, folder):
    return _rounded(tests.ttest_ind(tables.table(spark, folder, "orders"), "o_orderstatus", "o_totalprice", "O", "F"), 8, "t")


@query(
    "ttest_rel",
    f"""WITH {PAIRED} SELECT count(a - b) AS n, round(avg(a - b), 6) AS mean,
      round(avg(a - b) / (stddev_samp(a - b) / sqrt(count(a - b))), 8) AS t, count(a - b) - 1 AS df FROM pa""",
)
def ttest_rel(spark, folder):
    return _rounded(_rounded(tests.ttest_rel(tables.paired(spark, folder), "a", "b"), 6, "mean"), 8, "t")


@query(
    "wilcoxon",
    f"""WITH {PAIRED}, d AS (SELECT a - b AS d, abs(a - b) AS size FROM pa WHERE a <> b),
      r AS (SELECT d, rank() OVER (ORDER BY size) + (count(*) OVER (PARTITION BY size) - 1) / 2 AS rk FROM d),
      t AS (SELECT sum(power(c, 3) - c) AS tied FROM (SELECT count(*) AS c FROM d GROUP BY size) g),
      s AS (SELECT count(*) AS n, coalesce(sum(rk) FILTER (d > 0), 0) AS wp, coalesce(sum(rk) FILTER (d < 0), 0) AS wm FROM r)
    SELECT n, least(wp, wm) AS w,
      round((least(wp, wm) - n * (n + 1) / 4) / sqrt(CAST(n AS DOUBLE) * (n + 1) * (2 * n + 1) / 24 - tied / 48), 8) AS z FROM s, t""",
)
def wilcoxon(spark, folder):
    return _rounded(tests.wilcoxon(tables.paired(spark, folder), "a", "b"), 8, "z")


@query("test_p_values")
def test_p_values(spark, folder):
    """Two-sided p values of the four tests."""
    from tallymart.functions.distributions import normal_two_sided

    customer = tables.table(spark, folder, "customer")
    orders = tables.table(spark, folder, "orders")
    pairs = tables.paired(spark, folder)
    named = {
        "one sample": tests.ttest_1samp(customer, "c_acctbal", 4500.0),
        "two samples": tests.ttest_ind(orders, "o_orderstatus", "o_totalprice", "O", "F"),
        "paired": tests.ttest_rel(pairs, "a", "b"),
    }
    signed = tests.wilcoxon(pairs, "a", "b").select(
        F.lit("signed rank").alias("test"), F.col("z").alias("statistic"), normal_two_sided(F.col("z")).alias("p")
    )
    for name, result in named.items():
        row = tests.with_t_p_value(result).select(F.lit(name).alias("test"), F.col("t").alias("statistic"), "p")
        signed = signed.unionByName(row)
    return signed


# ---- one predictor ---------------------------------------------------------------------------

FIT = """ft AS (SELECT count(*) AS n, avg(x1) AS mx, avg(y) AS my, regr_sxx(y, x1) AS sxx, regr_syy(y, x1) AS syy,
    regr_sxy(y, x1) AS sxy FROM reg),
  co AS (SELECT *, sxy / sxx AS b, my - sxy / sxx * mx AS a, syy - sxy * sxy / sxx AS ssr, (syy - sxy * sxy / sxx) / (n - 2) AS s2 FROM ft)"""


@query(
    "ols_simple",
    f"WITH {REG} SELECT count(*) AS n, round(regr_slope(y, x1), 7) AS slope, round(regr_intercept(y, x1), 6) AS intercept, "
    "round(regr_r2(y, x1), 9) AS r2 FROM reg",
)
def ols_simple(spark, folder):
    fit = reg.simple_fit(_reg(spark, folder), "y", "x1").select("n", "slope", "intercept", "r2")
    return _rounded(_rounded(_rounded(fit, 7, "slope"), 6, "intercept"), 9, "r2")


@query(
    "ols_simple_by_group",
    """SELECT l_returnflag, count(*) AS n, round(regr_slope(l_extendedprice, l_quantity), 7) AS slope,
      round(regr_r2(l_extendedprice, l_quantity), 9) AS r2 FROM lineitem GROUP BY 1""",
)
def ols_simple_by_group(spark, folder):
    lines = tables.table(spark, folder, "lineitem")
    fit = reg.simple_fit(lines, "l_extendedprice", "l_quantity", ["l_returnflag"])
    return _rounded(_rounded(fit.select("l_returnflag", "n", "slope", "r2"), 7, "slope"), 9, "r2")


@query("ols_no_intercept", f"WITH {REG} SELECT count(*) AS n, round(sum(x1 * y) / sum(x1 * x1), 7) AS slope FROM reg")
def ols_no_intercept(spark, folder):
    return _rounded(reg.no_intercept_fit(_reg(spark, folder), "y", "x1"), 7, "slope")


@query(
    "ols_inference",
    f"""WITH {REG}, {FIT}, te AS (SELECT 'slope' AS term, b AS coefficient, sqrt(s2 / sxx) AS se, n - 2 AS df FROM co
      UNION ALL SELECT 'intercept', a, sqrt(s2 * (1 / n + mx * mx / sxx)), n - 2 FROM co)
    SELECT term, round(coefficient, 6) AS coefficient, round(se, 8) AS se, df, round(coefficient / se, 6) AS t FROM te""",
)
def ols_inference(spark, folder):
    rows = reg.inference(reg.simple_fit(_reg(spark, folder), "y", "x1")).select("term", "coefficient", "se", "df", "t")
    return _rounded(_rounded(rows, 6, "coefficient", "t"), 8, "se")


@query("ols_inference_limits")
def ols_inference_limits(spark, folder):
    """The same with p values and 95 % confidence limits."""
    return reg.inference(reg.simple_fit(_reg(spark, folder), "y", "x1"))


@query(
    "ols_fstat_loglik",
    f"""WITH {REG}, {FIT} SELECT n, round((syy - ssr) / s2, 4) AS f,
      round(-n / 2 * (ln(2 * pi() * ssr / n) + 1), 4) AS loglik FROM co""",
)
def ols_fstat_loglik(spark, folder):
    return _rounded(reg.fstat_loglik(reg.simple_fit(_reg(spark, folder), "y", "x1")).drop("p"), 4, "f", "loglik")


@query(
    "ols_categorical",
    """WITH m AS (SELECT o_orderpriority AS level, count(*) AS n, avg(o_totalprice) AS mean, var_pop(o_totalprice) AS v FROM orders GROUP BY 1),
      s AS (SELECT sum(n * v) / (sum(n) - count(*)) AS s2 FROM m), b AS (SELECT * FROM m ORDER BY level LIMIT 1)
    SELECT m.level, m.n, round(CASE WHEN m.level = b.level THEN m.mean ELSE m.mean - b.mean END, 5) AS coefficient,
      round(sqrt(s2 * (1 / m.n + CASE WHEN m.level = b.level THEN 0 ELSE 1 / b.n END)), 5) AS se FROM m, s, b""",
)
def ols_categorical(spark, folder):
    contrasts = reg.group_contrasts(tables.table(spark, folder, "orders"), "o_orderpriority", "o_totalprice")
    return _rounded(contrasts, 5, "coefficient", "se")


RESIDUAL = f"{FIT}, rs AS (SELECT reg.*, a + b * x1 AS fitted, y - (a + b * x1) AS residual FROM reg, co)"
RES_MOMENTS = f"{RESIDUAL}, {MOMENTS_SQL.format(v='residual', s='rs')}, sk AS (SELECT n, m3 / power(m2, 1.5) AS skew, m4 / (m2 * m2) AS kurt FROM pw)"


def _residuals(spark, folder) -> DataFrame:
    return reg.residuals(_reg(spark, folder), "y", "x1")


@query(
    "residuals",
    f"WITH {REG}, {RESIDUAL} SELECT {ROW_ORDER}, round(fitted, 5) AS fitted, round(residual, 5) AS residual FROM rs",
)
def residuals(spark, folder):
    return _rounded(_residuals(spark, folder).select(*ORDER, "fitted", "residual"), 5, "fitted", "residual")


@query(
    "omnibus",
    f"""WITH {REG}, {RES_MOMENTS},
      q1 AS (SELECT CAST(n AS DOUBLE) AS n, skew, kurt, skew * sqrt((n + 1.0) * (n + 3) / (6.0 * (n - 2))) AS y,
        3.0 * (n * n + 27.0 * n - 70) * (n + 1) * (n + 3) / ((n - 2.0) * (n + 5) * (n + 7) * (n + 9)) AS be FROM sk),
      q2 AS (SELECT *, -1 + sqrt(2 * (be - 1)) AS w2 FROM q1),
      q3 AS (SELECT *, sqrt(2 / (w2 - 1)) AS al FROM q2),
      q4 AS (SELECT *, ln(y / al + sqrt(power(y / al, 2) + 1)) / sqrt(ln(sqrt(w2))) AS z1 FROM q3),
      q5 AS (SELECT *, (kurt - 3 * (n - 1) / (n + 1)) / sqrt(24 * n * (n - 2) * (n - 3) / (power(n + 1, 2) * (n + 3) * (n + 5))) AS x,
        6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))) AS b1 FROM q4),
      q6 AS (SELECT *, 6 + 8 / b1 * (2 / b1 + sqrt(1 + 4 / power(b1, 2))) AS aa FROM q5),
      q7 AS (SELECT *, (1 - 2 / aa) / (1 + x * sqrt(2 / (aa - 4))) AS ra FROM q6),
      q8 AS (SELECT *, (1 - 2 / (9 * aa) - sign(ra) * power(abs(ra), 1.0 / 3)) / sqrt(2 / (9 * aa)) AS z2 FROM q7)
    SELECT CAST(n AS BIGINT) AS n, round(z1, 6) AS z_skewness, round(z2, 6) AS z_kurtosis, round(z1 * z1 + z2 * z2, 4) AS k2,
      round(exp(-(z1 * z1 + z2 * z2) / 2), 9) AS p FROM q8""",
)
def omnibus(spark, folder):
    result = tests.omnibus(rel.moments(_residuals(spark, folder), "residual"))
    return _rounded(_rounded(_rounded(result, 6, "z_skewness", "z_kurtosis"), 4, "k2"), 9, "p")


@query(
    "jarque_bera",
    f"""WITH {REG}, {RES_MOMENTS}, jb AS (SELECT *, n / 6 * (power(skew, 2) + power(kurt - 3, 2) / 4) AS jb FROM sk)
    SELECT n, round(skew, 8) AS skewness, round(kurt, 8) AS kurtosis, round(jb, 5) AS jb, round(exp(-jb / 2), 9) AS p FROM jb""",
)
def jarque_bera(spark, folder):
    result = tests.jarque_bera(rel.moments(_residuals(spark, folder), "residual"))
    return _rounded(_rounded(_rounded(result, 8, "skewness", "kurtosis"), 5, "jb"), 9, "p")


@query(
    "durbin_watson",
    f"""WITH {REG}, {RESIDUAL}, la AS (SELECT residual, lag(residual) OVER (ORDER BY {ROW_ORDER}) AS before FROM rs)
    SELECT count(*) AS n, round(sum(power(residual - before, 2)) / sum(power(residual, 2)), 9) AS dw FROM la""",
)
def durbin_watson(spark, folder):
    return _rounded(reg.durbin_watson(_residuals(spark, folder), "residual", ORDER), 9, "dw")


@query(
    "fit_with_without_outlier",
    f"""WITH {REG}, rn AS (SELECT y, x1, row_number() OVER (ORDER BY {", ".join(c + " DESC" for c in ORDER)}) AS r FROM reg)
    SELECT 'all' AS rows_used, count(*) AS n, round(regr_r2(y, x1), 9) AS r2 FROM rn
    UNION ALL SELECT 'without_last', count(*), round(regr_r2(y, x1), 9) FROM rn WHERE r > 1""",
)
def fit_with_without_outlier(spark, folder):
    return _rounded(reg.fit_without_last(_reg(spark, folder), "y", "x1", ORDER), 9, "r2")


@query(
    "prediction_interval",
    f"""WITH {REG}, {FIT} SELECT {ROW_ORDER}, round(a + b * x1, 5) AS fitted,
      round(sqrt(s2 * (1 + 1 / n + power(x1 - mx, 2) / sxx)), 6) AS se FROM reg, co""",
)
def prediction_interval(spark, folder):
    rows = reg.prediction_interval(_reg(spark, folder), "y", "x1").select(*ORDER, "fitted", "se")
    return _rounded(_rounded(rows, 5, "fitted"), 6, "se")


@query("prediction_limits")
def prediction_limits(spark, folder):
    return reg.prediction_interval(_reg(spark, folder), "y", "x1").select(*ORDER, "fitted", "low", "high")


@query(
    "cv_rmse",
    f"""WITH {REG}, f AS (SELECT y, x1, ntile(10) OVER (ORDER BY {ROW_ORDER}) AS fold FROM reg),
      m AS (SELECT k.fold, regr_slope(y, x1) AS b, regr_intercept(y, x1) AS a
        FROM range(1, 11) k(fold) JOIN f ON f.fold <> k.fold GROUP BY 1)
    SELECT count(*) AS n, count(DISTINCT f.fold) AS folds, round(sqrt(avg(power(y - a - b * x1, 2))), 6) AS rmse
    FROM f JOIN m ON m.fold = f.fold""",
)
def cv_rmse(spark, folder):
    return _rounded(reg.cv_rmse(_reg(spark, folder), "y", "x1", _order(), 10), 6, "rmse")


@query(
    "predict_new",
    f"""WITH {REG}, {FIT} SELECT p_partkey, CAST(p_size AS DOUBLE) AS x1, round(a + b * p_size, 5) AS prediction FROM part, co""",
)
def predict_new(spark, folder):
    fit = reg.simple_fit(_reg(spark, folder), "y", "x1")
    points = tables.table(spark, folder, "part").select("p_partkey", F.col("p_size").cast("double").alias("x1"))
    return _rounded(reg.predict_new(fit, points, "x1"), 5, "prediction")


# ---- several predictors ----------------------------------------------------------------------

# Cramer's rule on centred sums of squares and products of the three predictors
MULTI = """ce AS (SELECT y - avg(y) OVER () AS y, x1 - avg(x1) OVER () AS u, x2 - avg(x2) OVER () AS v, x3 - avg(x3) OVER () AS w FROM reg),
  mm AS (SELECT count(*) AS n, sum(u*u) AS uu, sum(v*v) AS vv, sum(w*w) AS ww, sum(u*v) AS uv, sum(u*w) AS uw, sum(v*w) AS vw,
    sum(u*y) AS uy, sum(v*y) AS vy, sum(w*y) AS wy, sum(y*y) AS yy FROM ce),
  dt AS (SELECT *, uu*(vv*ww - vw*vw) - uv*(uv*ww - vw*uw) + uw*(uv*vw - vv*uw) AS d FROM mm),
  be AS (SELECT *, (uy*(vv*ww - vw*vw) - uv*(vy*ww - vw*wy) + uw*(vy*vw - vv*wy)) / d AS b1,
    (uu*(vy*ww - vw*wy) - uy*(uv*ww - vw*uw) + uw*(uv*wy - vy*uw)) / d AS b2,
    (uu*(vv*wy - vy*vw) - uv*(uv*wy - vy*uw) + uy*(uv*vw - vv*uw)) / d AS b3 FROM dt),
  ss AS (SELECT *, (yy - b1*uy - b2*vy - b3*wy) / (n - 4) AS s2, (b1*uy + b2*vy + b3*wy) / yy AS r2 FROM be)"""


@query(
    "ols_multi",
    f"""WITH {REG}, {MULTI}, te AS (SELECT 'x1' AS term, b1 AS coefficient, sqrt(s2 * (vv*ww - vw*vw) / d) AS se, r2, n FROM ss
      UNION ALL SELECT 'x2', b2, sqrt(s2 * (uu*ww - uw*uw) / d), r2, n FROM ss
      UNION ALL SELECT 'x3', b3, sqrt(s2 * (uu*vv - uv*uv) / d), r2, n FROM ss)
    SELECT term, round(coefficient, 4) AS coefficient, round(se, 5) AS se, round(r2, 8) AS r2,
      round(1 - (1 - r2) * (n - 1) / (n - 4), 8) AS r2_adj FROM te""",
)
def ols_multi(spark, folder):
    rows = _reg(spark, folder)
    table = reg.coefficient_table(rows, reg.fit_multi(rows, "y", PREDICTORS), PREDICTORS)
    slopes = table.filter(F.col("term") != "intercept").select("term", "coefficient", "se", "r2", "r2_adj")
    return _rounded(_rounded(_rounded(slopes, 4, "coefficient"), 5, "se"), 8, "r2", "r2_adj")


@query("ols_multi_table")
def ols_multi_table(spark, folder):
    """The whole coefficient table, intercept, t and p included."""
    rows = _reg(spark, folder)
    return reg.coefficient_table(rows, reg.fit_multi(rows, "y", PREDICTORS), PREDICTORS)


@query("ols_encoded")
def ols_encoded(spark, folder):
    """Regression with a two-level and a three-level factor as 0/1 columns."""
    lines = tables.table(spark, folder, "lineitem").select(
        F.col("l_extendedprice").alias("y"), F.col("l_quantity").alias("x1"), "l_linestatus", "l_returnflag"
    )
    coded = rel.one_hot(rel.one_hot(lines, "l_linestatus", ["F", "O"], "status"), "l_returnflag", ["A", "N", "R"], "flag")
    predictors = ["x1", "status_O", "flag_N", "flag_R"]
    return reg.coefficient_table(coded, reg.fit_multi(coded, "y", predictors), predictors)


def _partial_sql(term: str, own: str, first: str, second: str, slope: str) -> str:
    """Residuals of y and one predictor on the two others, by Cramer's rule on the centred products."""

    def product(a: str, b: str) -> str:
        return "".join(sorted((a, b))) if "y" not in (a, b) else (b if a == "y" else a) + "y"

    def rest(z: str) -> str:
        ff, ss, fs = product(first, first), product(second, second), product(first, second)
        fz, sz = product(first, z), product(second, z)
        return f"c.{z} - (({fz}*{ss} - {fs}*{sz}) * c.{first} + ({ff}*{sz} - {fs}*{fz}) * c.{second}) / ({ff}*{ss} - {fs}*{fs})"

    whole = "c.y - b1*c.u - b2*c.v - b3*c.w"
    return f"""SELECT {", ".join(ORDER[:4])}, '{term}' AS predictor, round({rest("y")}, 3) AS y_residual,
      round({rest(own)}, 7) AS x_residual, round({slope} * c.{term} + {whole}, 3) AS component_plus_residual FROM keyed c, ss"""


KEYED = """keyed AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, x1, x2, x3, y - avg(y) OVER () AS y,
  x1 - avg(x1) OVER () AS u, x2 - avg(x2) OVER () AS v, x3 - avg(x3) OVER () AS w FROM reg)"""


@query(
    "partial_regression",
    f"WITH {REG}, {MULTI}, {KEYED} "
    + " UNION ALL ".join(
        _partial_sql(*names)
        for names in (("x1", "u", "v", "w", "b1"), ("x2", "v", "u", "w", "b2"), ("x3", "w", "u", "v", "b3"))
    ),
)
def partial_regression(spark, folder):
    parts = reg.partial_regression(_reg(spark, folder), "y", PREDICTORS, ORDER[:4])
    return _rounded(_rounded(parts, 3, "y_residual", "component_plus_residual"), 7, "x_residual")


@query(
    "split_rmse",
    f"""WITH {REG}, tr AS (SELECT * FROM reg WHERE l_orderkey % 4 <> 0), te AS (SELECT * FROM reg WHERE l_orderkey % 4 = 0),
      m AS (SELECT regr_slope(y, x1) AS b, regr_intercept(y, x1) AS a FROM tr)
    SELECT 'one' AS model, round((SELECT avg(power(y - a - b * x1, 2)) FROM tr, m), 2) AS train_mse,
      round((SELECT avg(power(y - a - b * x1, 2)) FROM te, m), 2) AS test_mse""",
)
def split_rmse(spark, folder):
    train, test = rel.modulus_split(_reg(spark, folder), F.col("l_orderkey"), 4, 1)
    scores = reg.split_scores(train, test, "y", {"one": ["x1"]})
    return _rounded(scores.select("model", "train_mse", "test_mse"), 2, "train_mse", "test_mse")


def _split_sql(model: str, weights: str) -> str:
    """Errors of one model; ``weights`` gives its three coefficients."""
    return f"""SELECT '{model}' AS model, avg(e * e) FILTER (part = 'train') AS train_mse, avg(e * e) FILTER (part = 'test') AS test_mse
      FROM (SELECT part, y - my - b1 * (x1 - m1) - b2 * (x2 - m2) - b3 * (x3 - m3) AS e FROM parts,
        (SELECT avg(y) AS my, avg(x1) AS m1, avg(x2) AS m2, avg(x3) AS m3 FROM reg) m, (SELECT {weights} FROM ss) b) r"""


@query(
    "split_rmse_models",
    f"""WITH {REG.replace("reg AS", "every AS")},
      parts AS (SELECT *, CASE WHEN l_orderkey % 4 <> 0 THEN 'train' ELSE 'test' END AS part FROM every),
      reg AS (SELECT * FROM parts WHERE part = 'train'), {MULTI}, scored AS (
        {_split_sql("all", "b1, b2, b3")} UNION ALL
        {_split_sql("without_x3", "(uy*vv - uv*vy) / (uu*vv - uv*uv) AS b1, (uu*vy - uv*uy) / (uu*vv - uv*uv) AS b2, 0 AS b3")} UNION ALL
        {_split_sql("one", "uy / uu AS b1, 0 AS b2, 0 AS b3")})
    SELECT model, round(train_mse, 2) AS train_mse, round(test_mse, 2) AS test_mse, round(sqrt(train_mse), 5) AS train_rmse,
      round(sqrt(test_mse), 5) AS test_rmse FROM scored""",
)
def split_rmse_models(spark, folder):
    """Train and test error with all predictors, without one, and with one only."""
    train, test = rel.modulus_split(_reg(spark, folder), F.col("l_orderkey"), 4, 1)
    scores = reg.split_scores(train, test, "y", {"all": PREDICTORS, "without_x3": ["x1", "x2"], "one": ["x1"]})
    return _rounded(_rounded(scores, 2, "train_mse", "test_mse"), 5, "train_rmse", "test_rmse")
