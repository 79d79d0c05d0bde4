"""Sparse collaborative filtering against dense numpy formulas and plain loops."""

import random

import numpy as np
import pytest

from tallymart.operators import neighbours as cf

USERS, ITEMS = 9, 11


@pytest.fixture(scope="module")
def cells():
    rng = random.Random(5)
    return {(u, i): float(rng.randrange(1, 6)) for u in range(USERS) for i in range(ITEMS) if rng.random() < 0.5}


@pytest.fixture(scope="module")
def ratings(spark, cells):
    return spark.createDataFrame([(u, i, r) for (u, i), r in cells.items()], "user_id int, item_id int, rating double")


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame([(2,)], "user_id int")


def dense(cells, skip=lambda u, i: False):
    m = np.zeros((USERS, ITEMS))
    for (u, i), r in cells.items():
        if not skip(u, i):
            m[u, i] = r
    return m


def distances(m):
    norms = np.linalg.norm(m, axis=1)
    norms[norms == 0] = 1
    d = 1 - (m / norms[:, None]) @ (m / norms[:, None]).T
    np.fill_diagonal(d, 0)
    return d


def cosines(m):
    c = 1 - distances(m)
    np.fill_diagonal(c, 1)  # an empty row is like itself only
    return c


def is_test(u, i):
    return (u + 2 * i) % 4 == 0


def test_memory_based_predictions_match_the_dense_formula(spark, cells, ratings):
    test = ratings.filter("(user_id + 2 * item_id) % 4 = 0")
    train = ratings.filter("(user_id + 2 * item_id) % 4 <> 0 AND user_id <> 3")  # user 3 has no training row
    m = dense(cells, lambda u, i: is_test(u, i) or u == 3)
    means = m.mean(axis=1)
    d = distances(m)
    by_user = means[:, None] + d @ (m - means[:, None]) / d.sum(axis=1)[:, None]
    e = distances(m.T)
    by_item = m @ e / e.sum(axis=1)[None, :]
    got = cf.user_based_cf(train, test, USERS, ITEMS).collect()
    assert len(got) == test.count() > 10
    for r in got:
        assert r.prediction == pytest.approx(by_user[r.user_id, r.item_id], abs=1e-9)
    for r in cf.item_based_cf(train, test, ITEMS).collect():
        assert r.prediction == pytest.approx(by_item[r.user_id, r.item_id], abs=1e-9)


def predicted(cells, m, weights):
    """Both dense predictions of every cell; ``weights`` turns cosines into weights."""
    n_users, n_items = m.shape
    means, d, e = m.mean(axis=1), weights(m), weights(m.T)
    by_user = means[:, None] + d @ (m - means[:, None]) / d.sum(axis=1)[:, None]
    by_item = m @ e / e.sum(axis=1)[None, :]
    return {c: (by_user[c], by_item[c]) for c in cells}


@pytest.mark.parametrize("weights", ["distance", "similarity"])
def test_predictions_are_the_same_in_small_blocks(spark, cells, ratings, weights):
    test = ratings.filter("(user_id + 2 * item_id) % 4 = 0").select("user_id", "item_id")
    train = ratings.filter("(user_id + 2 * item_id) % 4 <> 0")
    m = dense(cells, is_test)
    asked = [(u, i) for u, i in cells if is_test(u, i)]
    wanted = predicted(asked, m, distances if weights == "distance" else cosines)
    for got, side in (
        (cf.user_based_cf(train, test, USERS, ITEMS, weights, block_rows=2, hot_rows=3), 0),
        (cf.item_based_cf(train, test, ITEMS, weights, block_rows=2, hot_rows=3), 1),
    ):
        got = {(r.user_id, r.item_id): r.prediction for r in got.collect()}
        assert set(got) == set(asked)
        for cell, value in got.items():
            assert value == pytest.approx(wanted[cell][side], abs=1e-9)


def test_predictions_where_one_user_has_half_of_the_rows(spark):
    rng = np.random.default_rng(4)
    n_users, n_items = 60, 3000
    m = np.zeros((n_users, n_items))
    m[0] = rng.integers(1, 6, n_items)
    for u in range(1, n_users):
        m[u, rng.choice(n_items, 50, replace=False)] = rng.integers(1, 6, 50)
    asked = [(0, i) for i in range(0, n_items, 2)] + [(u, 7) for u in range(1, n_users)]
    for cell in asked:
        m[cell] = 0
    train = spark.createDataFrame([(int(u), int(i), float(m[u, i])) for u, i in np.argwhere(m)], "user_id int, item_id int, rating double")
    test = spark.createDataFrame([*asked, (0, 0)], "user_id int, item_id int")  # a repeated cell is answered twice
    rated = [c for c in asked if m[:, c[1]].any()]  # the dense form divides by the length of an item without raters
    wanted = predicted(rated, m, distances)
    got = cf.user_based_cf(train, test, n_users, n_items, block_rows=256, hot_rows=500).collect()
    assert len(got) == len(asked) + 1
    got = {(r.user_id, r.item_id): r.prediction for r in got}
    for cell in rated:
        assert got[cell] == pytest.approx(wanted[cell][0], abs=1e-9)


def test_cells_with_nulls_or_without_partners(spark, ratings):
    cells = spark.createDataFrame([(None, 1), (1, None), (77, 1), (1, 77)], "user_id int, item_id int")
    assert len(cf.user_based_cf(ratings, cells, USERS, ITEMS).collect()) == 4
    assert cf.item_based_cf(ratings, cells.limit(0), ITEMS).collect() == []


def test_correlations_far_from_zero(spark):
    rng = np.random.default_rng(8)
    m = 1e8 + rng.integers(1, 6, (7, 5)).astype(float)
    rows = spark.createDataFrame([(u, i, float(m[u, i])) for u in range(7) for i in range(5)], "user_id int, item_id int, rating double")
    by_user, by_item = np.corrcoef(m - 1e8), np.corrcoef(m.T - 1e8)
    for r in cf.pearson_users(rows).collect():
        assert r.similarity == pytest.approx(by_user[r.user_a, r.user_b], abs=1e-6) and abs(r.similarity) <= 1
    pairs = cf.item_correlation(rows).collect()
    assert len(pairs) == 10
    for r in pairs:
        assert r.correlation == pytest.approx(by_item[r.item_a, r.item_b], abs=1e-6) and abs(r.correlation) <= 1
    for r in cf.correlation_rows(rows, spark.createDataFrame([(2,)], "item_id int")).collect():
        assert r.correlation == pytest.approx(by_item[2, r.item_id], abs=1e-6)


def test_item_correlation_counts_missing_as_zero(cells, ratings):
    wanted = np.corrcoef(dense(cells).T)
    for r in cf.item_correlation(ratings).collect():
        assert r.correlation == pytest.approx(wanted[r.item_a, r.item_b], abs=1e-9)


def test_item_corr_scores_include_pairs_nobody_rated_together(cells, ratings, target):
    wanted = np.corrcoef(dense(cells).T)
    own = [i for i in range(ITEMS) if (2, i) in cells]
    got = {r.item_id: r.score for r in cf.item_corr_scores(ratings, target).collect()}
    assert set(got) == {i for i in range(ITEMS) if i not in own}
    for i, score in got.items():
        assert score == pytest.approx(wanted[i, own].sum(), abs=1e-9)


def test_slope_one_matches_the_pair_table(cells, ratings, target):
    own = {i: r for (u, i), r in cells.items() if u == 2}
    wanted = {}
    for i in set(range(ITEMS)) - set(own):
        top = bottom = 0
        for j, r in own.items():
            both = [(cells[u, i], cells[u, j]) for u in range(USERS) if (u, i) in cells and (u, j) in cells]
            if both:
                dev = sum(a - b for a, b in both) / len(both)
                top += (dev + r) * len(both)
                bottom += len(both)
        if bottom:
            wanted[i] = top / bottom
    got = {r.item_id: r.score for r in cf.slope_one_recs(ratings, target).collect()}
    assert got == pytest.approx(wanted)


def pearson(cells, u, v):
    common = [i for i in range(ITEMS) if (u, i) in cells and (v, i) in cells]
    if len(common) < 2:
        return 0.0
    x, y = (np.array([cells[w, i] for i in common]) for w in (u, v))
    return 0.0 if x.std() == 0 or y.std() == 0 else float(np.corrcoef(x, y)[0, 1])


def test_pearson_all_pairs_and_targets_agree(cells, ratings, target):
    for r in cf.pearson_users(ratings).collect():
        assert r.similarity == pytest.approx(pearson(cells, r.user_a, r.user_b), abs=1e-9)
    for r in cf.pearson_users(ratings, target).collect():
        assert r.similarity == pytest.approx(pearson(cells, 2, r.user_id), abs=1e-9)


def test_knn_for_one_user_is_the_same_as_for_all(ratings, target):
    whole = [tuple(r) for r in cf.knn_recs(ratings, 3, 5).filter("target = 2").collect()]
    assert sorted(whole) == sorted(tuple(r) for r in cf.knn_recs(ratings, 3, 5, target).collect())


def test_no_common_item_is_the_nearest(spark):
    rows = spark.createDataFrame([(1, 1, 5.0), (2, 1, 3.0), (3, 9, 4.0)], "user_id int, item_id int, rating double")
    target = spark.createDataFrame([(1,)], "user_id int")
    got = {r.user_id: r.distance for r in cf.manhattan_users(rows, target).collect()}
    assert got == {2: 2.0, 3: 0.0}
    assert [r.neighbour for r in cf.nearest_recs(rows, target).collect()] == [3]
    assert [r.user_id for r in cf.manhattan_users(rows, target, require_overlap=True).collect()] == [2]


def test_preferences_match_by_name(spark):
    items = spark.createDataFrame([(1, ["War", "Thriller"]), (2, ["Thriller"])], "item_id int, genres array<string>")
    likes = spark.createDataFrame([("Thriller", 1.0), ("War", 5.0)], "genre string, preference double")
    assert {r.item_id: r.score for r in cf.content_scores(items, likes).collect()} == {1: 6.0, 2: 1.0}
