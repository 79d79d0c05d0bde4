"""Statistics, curves, clusters and factorisations against identities and numpy."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymart.operators import classify, factorization, graph, hypothesis_tests, regression, relational, text

# ten points near a line and one far from it
REGIONS = [
    (round(2 + 0.8 * x + 0.1 * math.sin(7 * x), 3), x) for x in (2.5 + 0.2 * i for i in range(10))
] + [(2.2, 5.2)]


@pytest.fixture(scope="module")
def regions(spark):
    return spark.createDataFrame([(i, a, t) for i, (a, t) in enumerate(REGIONS)], "id int, alcohol double, tobacco double")


def test_paired_test_is_the_one_sample_test_of_the_difference(regions):
    paired = hypothesis_tests.ttest_rel(regions, "alcohol", "tobacco").first()
    single = hypothesis_tests.ttest_1samp(regions.withColumn("d", F.col("alcohol") - F.col("tobacco")), "d").first()
    assert paired.t == pytest.approx(single.t) and paired.df == 10
    d = np.array([a - t for a, t in REGIONS])
    assert paired.t == pytest.approx(d.mean() / (d.std(ddof=1) / math.sqrt(11)))


def test_outlier_hides_the_relation(regions):
    rows = {r.rows_used: r.r2 for r in regression.fit_without_last(regions, "alcohol", "tobacco", ["id"]).collect()}
    y, x = (np.array(v) for v in zip(*REGIONS))
    assert rows["all"] == pytest.approx(np.corrcoef(x, y)[0, 1] ** 2)
    assert rows["without_last"] == pytest.approx(np.corrcoef(x[:-1], y[:-1])[0, 1] ** 2)
    assert rows["without_last"] > 0.6 > 0.1 > rows["all"]


def test_one_and_many_predictor_fits_agree(regions):
    fit = regression.simple_fit(regions, "alcohol", "tobacco")
    closed = {r.term: r for r in regression.inference(fit).collect()}
    model = regression.fit_multi(regions, "alcohol", ["tobacco"])
    for r in regression.coefficient_table(regions, model, ["tobacco"]).collect():
        mine = closed["slope" if r.term == "tobacco" else r.term]
        assert mine.coefficient == pytest.approx(r.coefficient)
        assert mine.se == pytest.approx(r.se)
        assert mine.t == pytest.approx(r.t)
        assert mine.p == pytest.approx(r.p, abs=1e-9)
        assert mine.low < mine.coefficient < mine.high
    f = regression.fstat_loglik(fit).first()
    assert f.f == pytest.approx(closed["slope"].t ** 2)
    assert f.p == pytest.approx(closed["slope"].p)


def test_complement_sums_equal_refits(regions):
    y, x = (np.array(v) for v in zip(*REGIONS))
    sse, at = 0.0, 0
    for fold in range(4):
        size = 3 if fold < 3 else 2
        held = np.arange(at, at + size)
        at += size
        keep = np.setdiff1d(np.arange(11), held)
        b, a = np.polyfit(x[keep], y[keep], 1)
        sse += ((y[held] - a - b * x[held]) ** 2).sum()
    got = regression.cv_rmse(regions, "alcohol", "tobacco", [F.col("id")], 4).first()
    assert got.rmse == pytest.approx(math.sqrt(sse / 11))


def test_partial_regression_slope_is_the_multiple_coefficient(spark):
    rng = random.Random(2)
    data = [(i, rng.random(), rng.random()) for i in range(80)]
    df = spark.createDataFrame([(i, u, v, 2 * u - 3 * v + rng.random()) for i, u, v in data], "id int, u double, v double, y double")
    model = regression.fit_multi(df, "y", ["u", "v"])
    parts = regression.partial_regression(df, "y", ["u", "v"], ["id"])
    for name, weight in zip(["u", "v"], model.coefficients):
        slope = regression.no_intercept_fit(parts.filter(F.col("predictor") == name), "y_residual", "x_residual").first().slope
        assert slope == pytest.approx(weight)


def test_durbin_watson(regions):
    e = np.array([a for a, _ in REGIONS])
    got = regression.durbin_watson(regions, "alcohol", ["id"]).first().dw
    assert got == pytest.approx((np.diff(e) ** 2).sum() / (e**2).sum())


def test_moments(regions):
    v = np.array([a for a, _ in REGIONS])
    d = v - v.mean()
    row = relational.moments(regions, "alcohol").first()
    assert row.skewness == pytest.approx((d**3).mean() / (d**2).mean() ** 1.5)
    assert row.kurtosis == pytest.approx((d**4).mean() / (d**2).mean() ** 2)


def test_wilcoxon_small_case(spark):
    pairs = [(1.0, 0.0), (5.0, 3.0), (2.0, 4.0), (7.0, 7.0), (9.0, 6.0)]  # d = 1, 2, -2, 0, 3
    row = hypothesis_tests.wilcoxon(spark.createDataFrame(pairs, "a double, b double"), "a", "b").first()
    assert (row.n, row.w) == (4, 2.5)
    assert row.z == pytest.approx((2.5 - 5) / math.sqrt(4 * 5 * 9 / 24 - 6 / 48))


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(1)
    rows = [(int(rng.random() < 0.4), round(rng.random(), 1)) for _ in range(300)]
    return spark.createDataFrame(rows, "label int, score double")


def test_area_by_trapezoid_is_the_rank_sum(scored):
    points = [(r.fpr, r.tpr) for r in classify.roc_curve(scored).orderBy("fpr", "tpr").collect()]
    area = sum((x2 - x1) * (y1 + y2) / 2 for (x1, y1), (x2, y2) in zip(points, points[1:]))
    assert points[0] == (0, 0) and points[-1] == (1, 1)
    assert classify.roc_auc(scored).first().auc == pytest.approx(area)


def test_metric_identities(scored):
    guessed = scored.withColumn("guess", (F.col("score") > 0.5).cast("int"))
    m = classify.class_metrics(classify.confusion_matrix(guessed, "label", "guess")).first()
    assert m.accuracy + m.error == pytest.approx(1) and m.specificity + m.false_positive_rate == pytest.approx(1)
    point = classify.threshold_eval(classify.roc_curve(scored), 0.5).first()
    assert point.sensitivity == pytest.approx(m.recall) and point.specificity == pytest.approx(m.specificity)


def test_rates_without_cases_are_null(spark):
    only = spark.createDataFrame([(0, 0)], "label int, guess int")
    assert classify.class_metrics(classify.confusion_matrix(only, "label", "guess")).first().recall is None


def test_stratified_folds_keep_the_class_share(scored):
    rows = scored.withColumn("id", F.monotonically_increasing_id())
    sizes = classify.stratified_folds(rows, "label", ["id"], 7).groupBy("fold", "label").count().collect()
    for label in (0, 1):
        counts = [r["count"] for r in sizes if r.label == label]
        assert len(counts) == 7 and max(counts) - min(counts) <= 1


@pytest.mark.parametrize(
    "a, b, nmi, ari",
    [([0, 0, 1, 1], [5, 5, 3, 3], 1, 1), ([0, 0, 0, 0], [1, 1, 1, 1], 1, 1), ([0, 0, 0, 0], [0, 1, 2, 3], 0, 0), ([0, 0, 1, 1], [0, 1, 0, 1], 0, -0.5)],
)
def test_agreement(spark, a, b, nmi, ari):
    row = graph.agreement(spark.createDataFrame(list(zip(a, b)), "a int, b int"), "a", "b").first()
    assert row.nmi == pytest.approx(nmi, abs=1e-9) and row.ari == pytest.approx(ari, abs=1e-9)
    assert row.score == pytest.approx((nmi + ari) / 2, abs=1e-9)


def test_two_cliques_are_found(spark):
    links = [(i, j, 1.0) for base in (0, 5) for i in range(base, base + 5) for j in range(i + 1, base + 5)] + [(4, 5, 0.1)]
    edges = spark.createDataFrame(links, "src long, dst long, w double")
    truth = spark.createDataFrame([(i, i // 5) for i in range(10)], "node long, truth int")
    for clusters in (graph.kmeans_clusters(edges), graph.spectral_clusters(edges)):
        joined = clusters.join(truth, "node")
        assert graph.agreement(joined, "truth", "cluster").first().ari == pytest.approx(1)


def test_words_keep_letters_of_every_script(spark):
    docs = spark.createDataFrame([(1, "Été: the_END, 3x ÇA!"), (2, ""), (3, "İstanbul")], "doc_id int, text string")
    got = [(r.doc_id, r.position, r.token) for r in text.tokenize(docs).orderBy("doc_id", "position").collect()]
    assert got[:4] == [(1, 0, "été"), (1, 1, "the_end"), (1, 2, "3x"), (1, 3, "ça")]
    assert [t for d, _, t in got if d == 3] == ["İstanbul".lower()]
    assert [r.token for r in text.stopword_filter(text.tokenize(docs), ["ça"]).filter("doc_id = 1").collect()] == ["été", "the_end", "3x"]


def test_polarity_cuts(spark):
    docs = spark.createDataFrame([(1, "good good"), (2, "plain"), (3, "worst war")], "doc_id int, text string")
    labels = {r.doc_id: (r.label, r.score) for r in text.polarity(docs, text.lexicon_table(docs)).collect()}
    assert {k: v[0] for k, v in labels.items()} == {1: "positive", 2: "neutral", 3: "negative"}
    assert labels[1][1] == pytest.approx(3.8 / math.sqrt(3.8**2 + 15))
    assert text.polarity_label(docs, text.lexicon_table(docs)).count() == 2


@pytest.fixture(scope="module")
def low_rank(spark):
    rng = np.random.default_rng(0)
    m = rng.random((30, 4)) @ rng.random((4, 12)) + 1
    return m, spark.createDataFrame([(u, i, float(m[u, i])) for u in range(30) for i in range(12)], "user_id int, item_id int, rating double")


def test_svd_matches_numpy(low_rank):
    m, cells = low_rank
    u, s, vt = np.linalg.svd(m)
    errors = []
    for k in (1, 3):
        factors = factorization.svd(cells, "user_id", "item_id", "rating", k)
        assert factors.values == pytest.approx(s[:k], rel=1e-6)
        best = (u[:, :k] * s[:k]) @ vt[:k]
        rows = factorization.reconstruct(factors, cells, "user_id", "item_id").collect()
        for r in rows:
            assert r.prediction == pytest.approx(best[r.user_id, r.item_id], abs=1e-6)
        errors.append(sum((r.rating - r.prediction) ** 2 for r in rows))
    assert errors[1] < errors[0]


def test_svd_over_several_blocks_matches_numpy(spark):
    rng = np.random.default_rng(2)
    u, v = np.linalg.qr(rng.normal(size=(45, 20)))[0], np.linalg.qr(rng.normal(size=(37, 20)))[0]
    m = (u * 2.0 ** -np.arange(20)) @ v.T  # every value half the one before
    m[3, :] = 0
    m[3, 5] = 1e-3
    cells = [(int(i) * 10**11, int(j), float(m[i, j])) for i in range(45) for j in range(37) if m[i, j]]
    frame = spark.createDataFrame(cells, "user_id long, item_id long, rating double")
    values = np.linalg.svd(m)[1]
    factors = factorization.svd(frame, "user_id", "item_id", "rating", 4, steps=20, tall=8)
    assert factors.values == pytest.approx(values[:4], rel=1e-6)
    left = np.array([r.u for r in factors.left.orderBy("user_id").collect()])
    right = np.array([r.v for r in factors.right.orderBy("item_id").collect()])
    assert left.shape == (45, 4) and right.shape == (37, 4)
    assert np.allclose(left.T @ left, np.eye(4), atol=1e-9) and np.allclose(right.T @ right, np.eye(4), atol=1e-6)
    a, s, b = np.linalg.svd(m)
    assert np.allclose((left * factors.values) @ right.T, (a[:, :4] * s[:4]) @ b[:4], atol=1e-5)
    pairs = spark.createDataFrame([(0, 10**11), (0, 7)], "a long, b long")
    found = {r.b: r.similarity for r in factorization.latent_pairs(factors, "user_id", pairs).collect()}
    x, y = left[0] * factors.values, left[1] * factors.values
    assert found[10**11] == pytest.approx(x @ y / np.linalg.norm(x) / np.linalg.norm(y), abs=1e-9) and found[7] is None


def test_svd_recommendations_leave_seen_cells_out(spark, low_rank):
    _, cells = low_rank
    seen = cells.filter("(user_id + item_id) % 3 <> 0")
    centred = factorization.centred(seen, "item_id", 2)
    factors = factorization.svd(centred, "item_id", "user_id", "value", 3)
    means = centred.groupBy("item_id").agg(F.max("row_mean").alias("row_mean"))
    target = spark.createDataFrame([(4,)], "user_id int")
    recs = factorization.svd_recommend(factors, means, seen, target, "user_id", "item_id", 3).collect()
    assert len(recs) == 3 and all((4 + r.item_id) % 3 == 0 for r in recs)
    assert [r.prediction for r in recs] == sorted((r.prediction for r in recs), reverse=True)
    clipped = factorization.svd_predict(factors, means, seen, "item_id", "user_id", 0.0, 1.5)
    assert clipped.agg(F.max("prediction")).first()[0] <= 1.5
    similar = factorization.latent_similar(factors, "item_id", spark.createDataFrame([(1,)], "item_id int"), 4).collect()
    assert len(similar) == 4 and all(abs(r.similarity) <= 1 + 1e-9 and r.item_id != 1 for r in similar)


def test_als_lists_and_errors(spark, low_rank):
    _, cells = low_rank
    model = factorization.fit_als(cells, implicit=False, rank=3, regParam=0.01)
    recs = factorization.recs_for_all_users(model, 4).collect()
    assert len(recs) == 30 * 4
    for user in range(3):
        scores = [r.score for r in sorted((r for r in recs if r.user_id == user), key=lambda r: r["rank"])]
        assert scores == sorted(scores, reverse=True)
    curve = factorization.learning_curve(cells, cells, [1, 6], rank=3, regParam=0.01)
    error = {r.epoch: r.rmse for r in curve.filter("part = 'train'").collect()}
    assert error[6] < error[1]
    strangers = spark.createDataFrame([(999, 1)], "user_id int, item_id int")
    assert factorization.predict(model, strangers).count() == 0
    doubled = cells.unionByName(cells)
    both = {d: factorization.rmse_train_test(model, doubled, cells, d).filter("part = 'train'").first().n for d in (False, True)}
    assert both == {False: 720, True: 360}


def test_als_blocks_do_not_follow_the_cluster_and_long_runs_free_their_files(spark, low_rank, monkeypatch):
    _, cells = low_rank
    seen, real = [], factorization.ALS
    monkeypatch.setattr(factorization, "ALS", lambda **options: seen.append(options) or real(**options))
    factorization.fit_als(cells, implicit=True, rank=3, maxIter=1)
    assert (seen[0]["numUserBlocks"], seen[0]["numItemBlocks"]) == (10, 4)
    factorization.learning_curve(cells, cells, [2], rank=3)
    assert seen[1]["checkpointInterval"] < 8
    fewer, more = (factorization.fit_als(cells, implicit=False, rank=3, numItemBlocks=n).userFactors for n in (4, 10))
    pairs = fewer.join(more.withColumnRenamed("features", "other"), "id").collect()
    assert len(pairs) == 30
    assert all(abs(x - y) < 1e-4 for r in pairs for x, y in zip(r.features, r.other))


def test_errors_over_all_and_distinct_rows_come_from_one_scoring(spark, low_rank):
    _, cells = low_rank
    model = factorization.fit_als(cells, implicit=False, rank=3, regParam=0.01)
    train, test = cells.unionByName(cells.filter("user_id < 7")), cells.filter("item_id % 2 = 0")
    found = {(r.part, r.rows_used): r for r in factorization.rmse_all_and_distinct(model, train, test).collect()}
    for kind in ("all", "distinct"):
        for r in factorization.rmse_train_test(model, train, test, kind == "distinct").collect():
            one = found.pop((r.part, kind))
            assert one.n == r.n and abs(one.rmse - r.rmse) < 1e-9 and abs(one.mse - r.mse) < 1e-9
    assert not found


def test_cross_validated_area_fits_each_fold_once(spark, monkeypatch):
    import numpy as np
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    rows = spark.createDataFrame([(i, float(i * 37 % 101), float(i % 7), int(i * 37 % 101 + i % 5 * 20 > 90)) for i in range(300)], "no int, a double, b double, label int")
    fits, real = [], classify.LogisticRegression._fit
    monkeypatch.setattr(classify.LogisticRegression, "_fit", lambda self, df: fits.append(1) or real(self, df))
    found = classify.cv_auc(rows, "label", ["a", "b"], ["no"], k=3).first()
    assert len(fits) == 3
    folds = classify.stratified_folds(rows, "label", ["no"], 3)
    scorer = BinaryClassificationEvaluator(labelCol="label", numBins=0)
    areas = []
    for fold in (1, 2, 3):
        train, test = (classify._features(folds.filter(which), ["a", "b"]) for which in (f"fold <> {fold}", f"fold = {fold}"))
        areas.append(scorer.evaluate(classify.LogisticRegression(labelCol="label", maxIter=50).fit(train).transform(test)))
    assert found.folds == 3 and abs(found.mean_auc - np.mean(areas)) < 1e-9 and abs(found.sd_auc - np.std(areas)) < 1e-9
