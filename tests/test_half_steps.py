"""The learning curve holds every epoch, and each is the state of a fit with that many iterations."""

import os

import pytest

from tallymart.operators import factorization, half_steps
from tallymart.session import discard, scratch_path, write_through


def _split(spark):
    cells = [(u * 7, i + 100, float((u * 3 + i * 5 + u * i) % 5 + 1)) for u in range(40) for i in range(25) if (u + i * i) % 3]
    train = spark.createDataFrame([c for c in cells if (c[0] + c[1]) % 4], "user_id long, item_id long, rating double")
    test = [c for c in cells if not (c[0] + c[1]) % 4] + [(9999, 101, 2.0), (7, 8888, 3.0), (7, 101, None)]
    return train.unionByName(train.limit(5)), spark.createDataFrame(test, "user_id long, item_id long, rating double")


def test_every_epoch_is_listed_and_is_that_of_a_fit(spark):
    train, test = _split(spark)
    curve = factorization.learning_curve(train, test, [1, 4], rank=3, regParam=0.05).collect()
    assert sorted((r.epoch, r.part) for r in curve) == [(e, p) for e in (1, 2, 3, 4) for p in ("test", "train")]
    for epoch in (2, 3):
        model = factorization.fit_als(train, implicit=False, rank=3, regParam=0.05, maxIter=epoch)
        for r in factorization.rmse_train_test(model, train, test).collect():
            found = next(c for c in curve if (c.epoch, c.part) == (epoch, r.part))
            assert found.n == r.n and found.rmse == pytest.approx(r.rmse, rel=1e-4)


def test_blocks_and_slices_do_not_change_a_step(spark, monkeypatch):
    train, test = _split(spark)
    rows = train.selectExpr("int(user_id) user", "int(item_id) item", "rating", "'train' part")
    start = factorization.fit_als(train, implicit=False, rank=3, maxIter=0).userFactors
    found = []
    for block_rows in (10, 10_000):
        last = [*half_steps.HalfSteps(rows, 3, 0.1, block_rows).epochs(start, 2)][-1]
        found.append(last.first().rmse)
        monkeypatch.setattr(half_steps, "AT_ONCE", 7)
        monkeypatch.setattr(half_steps, "SOLVED", 3)
    assert found[0] == pytest.approx(found[1], rel=1e-6)


def test_ids_and_ratings_that_als_refuses_end_the_run(spark):
    train, test = _split(spark)
    for bad in ("(null, 1, 2.0)", "(1, 3000000000, 2.0)", "(1, 1, null)"):
        more = train.unionByName(spark.sql(f"SELECT * FROM VALUES {bad} AS t(user_id, item_id, rating)"))
        with pytest.raises(Exception, match="ALS needs"):
            factorization.learning_curve(more, test, [1], rank=3)


def test_discard_removes_what_was_written(spark):
    path = scratch_path(spark, "gone")
    assert write_through(spark.range(5), path=path).count() == 5 and os.path.exists(path)
    discard(spark, path)
    assert not os.path.exists(path)
