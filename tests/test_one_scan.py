"""Lags over a total order, models from one scan, quantiles by narrowing: each against plain Python."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymart.operators import graph, ordering, regression, relational
from tallymart.operators.gram import grams

Y, P = "y", ["a", "b", "c"]


@pytest.fixture(scope="module")
def steps(spark):
    draw = random.Random(4)
    # group "hot" holds most rows, some values and one group name are null
    rows = [(("hot" if i % 3 else draw.choice(["x", "y", None])), i, draw.choice([None, draw.random()])) for i in range(400)]
    draw.shuffle(rows)
    return rows, spark.createDataFrame(rows, "g string, i int, v double").repartition(7)


@pytest.mark.parametrize("n", [1, 2, 5, 120, 500])
def test_lag_over_the_whole_order(steps, n):
    rows, df = steps
    by_place = sorted(rows, key=lambda r: r[1])
    want = {r[1]: by_place[at - n][2] if at >= n else None for at, r in enumerate(by_place)}
    got = ordering.lagged(df, [F.col("i")], n, before="v")
    assert got.columns == ["g", "i", "v", "before"]
    assert {r.i: r.before for r in got.collect()} == want


@pytest.mark.parametrize("n", [1, 3])
def test_lag_within_groups(steps, n):
    rows, df = steps
    got = {r.i: (r.before, r.at) for r in ordering.lagged(df, [F.col("i")], n, ("g",), before="v", at="i").collect()}
    for name in ("hot", "x", "y", None):
        own = sorted((r for r in rows if r[0] == name), key=lambda r: r[1])
        for place, row in enumerate(own):
            assert got[row[1]] == ((own[place - n][2], own[place - n][1]) if place >= n else (None, None))
    assert len(got) == len(rows)


def test_lag_of_nothing(steps):
    assert ordering.lagged(steps[1].filter("i < 0"), [F.col("i")], before="v").collect() == []


@pytest.fixture(scope="module")
def table(spark):
    draw = np.random.default_rng(8)
    a, b = draw.normal(1e8, 1, 300), draw.normal(size=300)
    c = 0.3 * b + draw.normal(size=300)
    y = 2 * (a - 1e8) - b + 0.1 * c + draw.normal(size=300)
    rows = [list(map(float, r)) for r in zip(y, a, b, c)]
    for at in range(0, 300, 7):
        rows[at][at % 4] = None
    rows[5] = [None] * 4
    return rows, spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, y double, a double, b double, c double")


def _solved(rows, y, predictors):
    names = [Y, *P]
    at = [names.index(p) for p in predictors]
    whole = np.array([[r[names.index(y)], *(r[i] for i in at)] for r in rows if None not in (r[names.index(y)], *(r[i] for i in at))])
    centre = whole.mean(axis=0)
    weights = np.linalg.lstsq(whole[:, 1:] - centre[1:], whole[:, 0] - centre[0], rcond=None)[0]
    return whole, weights, centre[0] - weights @ centre[1:]


@pytest.mark.parametrize("predictors", [["a"], ["b", "c"], ["a", "b", "c"], []])
def test_models_of_one_scan(table, predictors):
    rows, df = table
    fit = grams(df, [Y, *P]).of([Y, *predictors]).fit(Y, predictors)
    whole, weights, intercept = _solved(rows, Y, predictors)
    assert fit.n == len(whole) and fit.df == len(whole) - 1 - len(predictors)
    assert fit.coefficients == pytest.approx(weights, rel=1e-7)
    assert fit.intercept == pytest.approx(intercept, rel=1e-7)
    rest = whole[:, 0] - whole.mean(axis=0)[0] - (whole[:, 1:] - whole.mean(axis=0)[1:]) @ weights
    d = whole[:, 1:] - whole.mean(axis=0)[1:]
    errors = np.sqrt(np.diag(np.linalg.pinv(d.T @ d)) * (rest @ rest) / fit.df) if predictors else []
    assert fit.se[:-1] == pytest.approx(errors, rel=1e-6)
    # doubles near the offset of 1e8 lie 1.5e-8 apart
    assert fit.r2 == pytest.approx(1 - rest @ rest / ((whole[:, 0] - whole[:, 0].mean()) ** 2).sum(), abs=1.5e-8)


def test_redundant_and_constant_predictors(spark):
    rows = [(float(i), 2.0 * i, 5.0, 3.0 * i + (-1) ** i) for i in range(20)]
    df = spark.createDataFrame(rows, "a double, twice double, same double, y double")
    one = regression.fit_multi(df, "y", ["a"])
    all_of = regression.fit_multi(df, "y", ["a", "twice", "same"])
    assert all_of.coefficients.tolist() == pytest.approx([one.coefficients[0], 0, 0]) and all_of.df == one.df == 18
    terms = {r.term: r for r in regression.coefficient_table(df, all_of, ["a", "twice", "same"]).collect()}
    assert terms["twice"].se is None and terms["same"].p is None and terms["a"].se == pytest.approx(one.se[0])


def test_models_without_enough_rows(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 1.0)], "y double, a double")
    none = regression.coefficient_table(df, regression.fit_multi(df.limit(0), "y", ["a"]), ["a"]).collect()
    assert [(r.coefficient, r.se, r.p, r.r2) for r in none] == [(None, None, None, None)] * 2
    single = {r.term: r for r in regression.coefficient_table(df, regression.fit_multi(df, "y", ["a"]), ["a"]).collect()}
    assert single["intercept"].coefficient == 1.0 and single["a"].se is None and single["a"].r2_adj is None
    scores = regression.split_scores(df, df.limit(0), "y", {"m": ["a"]}).first()
    assert (scores.train_mse, scores.test_mse, scores.test_rmse) == (0.0, None, None)


def test_split_scores_use_each_models_own_rows(table):
    rows, df = table
    train, test = df.filter("i % 3 > 0"), df.filter("i % 3 = 0")
    got = {r.model: r for r in regression.split_scores(train, test, Y, {"all": P, "b": ["b"]}).collect()}
    for name, predictors in (("all", P), ("b", ["b"])):
        _, weights, intercept = _solved([r for i, r in enumerate(rows) if i % 3], Y, predictors)
        for part, label in ((0, "test_mse"), (1, "train_mse")):
            whole, _, _ = _solved([r for i, r in enumerate(rows) if bool(i % 3) == bool(part)], Y, predictors)
            e = whole[:, 0] - intercept - whole[:, 1:] @ weights
            assert got[name][label] == pytest.approx((e**2).mean(), rel=1e-5)


def _quantile(values, f):
    values = sorted(values)
    at = (len(values) - 1) * f
    low = math.floor(at)
    high = math.ceil(at)
    return values[low] + (values[high] - values[low]) * (at - low)


@pytest.mark.parametrize("accuracy", [2, 20, 10_000])
def test_narrowed_quantiles(spark, accuracy):
    draw = random.Random(6)
    rows = [(draw.choice([None, draw.gauss(0, 1e6)]), draw.choice([1, 1, 1, 2, 9]), 4.0, None) for _ in range(3000)]
    rows += [(math.inf, 1, 4.0, None)]
    df = spark.createDataFrame(rows, "x double, hot int, same double, none double").repartition(5)
    fractions = {"lo": 0.0, "q": 0.37, "mid": 0.5, "hi": 1.0}
    got = {r.column_name: r for r in relational.narrowed_quantiles(df, df.columns, fractions, accuracy).collect()}
    for i, column in enumerate(df.columns):
        values = [r[i] for r in rows if r[i] is not None]
        for name, f in fractions.items():
            if not values:
                assert got[column][name] is None
            elif name == "hi" and column == "x":
                assert got[column][name] == math.inf or math.isnan(got[column][name])
            else:
                assert got[column][name] == pytest.approx(_quantile(values, f))


def test_describe_of_nothing(spark):
    df = spark.createDataFrame([], "x double, g string")
    row = relational.describe(df, ["x"]).first()
    assert (row.column_name, row.n, row.mean, row.q50) == ("x", 0, None, None)
    assert relational.describe(df, ["x"], ["g"]).collect() == []


def _kmeans(links, k):
    """The same start and rounds on a dense matrix."""
    nodes = sorted({n for link in links for n in link})
    x = np.eye(len(nodes))
    for a, b in links:
        x[nodes.index(a), nodes.index(b)] = x[nodes.index(b), nodes.index(a)] = 1

    def gaps(centres):
        return np.round(((x[:, None] - centres[None]) ** 2).sum(axis=2), 9)

    seeds = [int(x.sum(axis=1).argmax())]
    while len(seeds) < k:
        near = gaps(x[seeds]).min(axis=1)
        if near.max() == 0:
            break
        seeds.append(int(near.argmax()))
    now = gaps(x[seeds]).argmin(axis=1)
    for _ in range(40):
        centres = np.array([x[now == i].mean(axis=0) if (now == i).any() else 0 * x[0] for i in range(len(seeds))])
        then, now = now, gaps(centres).argmin(axis=1)
        if (then == now).all():
            break
    return dict(zip(nodes, now.tolist()))


@pytest.mark.parametrize("k", [1, 2, 3])
def test_kmeans_on_edges(spark, k):
    draw = random.Random(k)
    links = {(a, b) for a in range(0, 36) for b in range(a + 1, 36) if draw.random() < (0.7 if a // 12 == b // 12 else 0.05)}
    links |= {(0, b) for b in range(1, 36)}  # one node meets all others
    edges = spark.createDataFrame([(a, b, 1.0) for a, b in links], "src long, dst long, w double")
    got = {r.node: r.cluster for r in graph.kmeans_clusters(edges, k).collect()}
    assert got == _kmeans(links, k)


def test_kmeans_of_few_rows(spark):
    kind = "src long, dst long, w double"
    assert graph.kmeans_clusters(spark.createDataFrame([], kind)).collect() == []
    pair = spark.createDataFrame([(1, 2, 1.0), (1, 2, 1.0)], kind)
    assert {r.node: r.cluster for r in graph.kmeans_clusters(pair, 5).collect()} == {1: 0, 2: 0}
