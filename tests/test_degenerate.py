"""Ordinary data that leaves a denominator at zero."""

from pyspark.sql import functions as F

from tallymart.operators import classify, hypothesis_tests, neighbours, regression, relational, timeseries


def test_constant_columns(spark):
    rows = spark.createDataFrame([(1.0, 2.0, 1)] * 3, "x double, y double, label int")
    fit = regression.simple_fit(rows, "y", "x").first()
    assert fit.slope is None and fit.r2 is None
    assert hypothesis_tests.ttest_1samp(rows, "x").first().t is None
    assert relational.moments(rows, "x").first().skewness is None
    assert {row.fpr for row in classify.roc_curve(rows, "label", "x").collect()} <= {0.0, None}


def test_all_zero_ratings(spark):
    rows = spark.createDataFrame([(1, 7, 0.0), (2, 7, 3.0)], "user_id long, item_id long, rating double")
    assert [(row.user_a, row.user_b, row.similarity) for row in neighbours.cosine_users(rows).collect()] == [(1, 2, 0.0)]
    given = neighbours.neighbours_of(rows, spark.createDataFrame([(7,)], "item_id long"), 5)
    assert given.collect() == []


def test_regressions_without_variance(spark):
    flat = spark.createDataFrame([(i, 1.0, float(i), 0.0) for i in range(6)], "i long, x double, y double, zero double")
    assert regression.no_intercept_fit(flat, "y", "zero").first().slope is None
    fit = regression.simple_fit(flat, "y", "x")
    assert [(r.se, r.t, r.p) for r in regression.inference(fit).collect()] == [(None, None, None)] * 2
    assert regression.fstat_loglik(fit).first().f is None
    assert regression.cv_rmse(flat, "y", "x", [F.col("i")], 3).first().rmse is None
    assert regression.durbin_watson(flat, "zero", ["i"]).first().dw is None
    assert {r.se for r in regression.prediction_interval(flat, "y", "x").collect()} == {None}


def test_one_row_in_every_group(spark):
    rows = spark.createDataFrame([("a", 1.0), ("b", 4.0)], "g string, v double")
    assert [(r.level, r.coefficient, r.se) for r in regression.group_contrasts(rows, "g", "v").orderBy("level").collect()] == [
        ("a", 1.0, None),
        ("b", 3.0, None),
    ]


def test_calendar_covers_all_prices(spark):
    rows = spark.sql("SELECT * FROM VALUES ('a', DATE'1994-12-30', 1.0D), ('a', DATE'2002-03-01', 2.0D) t(ticker, date, price)")
    found = timeseries.price_panel(rows).orderBy("date").collect()
    assert len(found) == 1871 and (found[0].price, found[-2].price, found[-1].price) == (1.0, 1.0, 2.0)
