"""Pairs are built in the task that owns a member: right for hot members, and no pair travels as a row."""

import random
from collections import defaultdict
from itertools import permutations

import pytest

from tallymart.operators import neighbours, pairs


@pytest.fixture(scope="module")
def cells():
    rng = random.Random(8)
    return {(u, i): float(rng.randrange(1, 6)) for u in range(14) for i in range(30) if i == 0 or u == 0 or rng.random() < 0.3}


@pytest.fixture(scope="module")
def frame(spark, cells):
    extra = [(None, 1, 5.0), (1, None, 5.0)]
    return spark.createDataFrame([(u, i, r) for (u, i), r in cells.items()] + extra, "user_id long, item_id long, rating double")


@pytest.mark.parametrize("at_once", [7, 500_000])
@pytest.mark.parametrize("block_rows", [3, 1000])
@pytest.mark.parametrize("both", [False, True])
def test_sums_of_pairs(frame, cells, at_once, block_rows, both):
    got = pairs.pair_sums(frame, "user_id", "item_id", block_rows=block_rows, hot_rows=6, both=both, at_once=at_once)
    got = {(r.a, r.b): (r.n, r.sx, r.sxy) for r in got.collect()}
    wanted = defaultdict(lambda: [0, 0.0, 0.0])
    for (u, i), (v, j) in permutations(cells, 2):
        if u == v and (i != j if both else i < j):
            sums = wanted[i, j]
            sums[0], sums[1], sums[2] = sums[0] + 1, sums[1] + cells[u, i], sums[2] + cells[u, i] * cells[v, j]
    assert got == {k: tuple(v) for k, v in wanted.items()}


def test_products_of_hot_rows(frame, cells):
    rows = frame.withColumn("unit", frame["rating"])
    names = "user_id", "item_id", "unit", "rating", "unit"
    plain = pairs.cell_products(frame, rows, *names)
    small = pairs.cell_products(frame, rows, *names, block_rows=3, hot_rows=6, at_once=5)
    wanted = defaultdict(float)
    for (u, i) in cells:
        for (v, k) in cells:
            if k == i:
                wanted[u, i] += cells[v, i] * sum(cells[u, j] * cells[v, j] for j in range(30) if (u, j) in cells and (v, j) in cells)
    for found in (plain, small):
        assert {(r.user_id, r.item_id): r.product for r in found.collect()} == pytest.approx(dict(wanted))


def test_pairs_are_added_up_without_a_shuffle_of_their_own(frame):
    """The last exchange below the sums is that of the lists: none has a pair of members as its key."""
    for found in (pairs.pair_sums(frame, "user_id", "item_id"), neighbours.item_correlation(frame)):
        plan = found._jdf.queryExecution().executedPlan().toString()
        exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
        assert exchanges and not any("_b#" in line or "b#" in line.split("hashpartitioning(")[1].split("),")[0] for line in exchanges), plan


def test_ids_above_four_bytes(spark):
    big = 2**40
    rows = spark.createDataFrame([(1, big, 1.0), (1, 2, 2.0), (2, big, 3.0), (2, 2, 4.0)], "g long, m long, rating double")
    assert [(r.a, r.b, r.sxy) for r in pairs.pair_sums(rows, "g", "m").collect()] == [(2, big, 14.0)]


@pytest.mark.parametrize("at_once", [3, 500_000])
def test_listed_sums_keep_rows_without_a_member(spark, at_once):
    own = spark.createDataFrame([(1, 7, 0.5), (1, 8, 2.0), (2, 8, 1.0)], "item long, near long, weight double")
    rows = spark.createDataFrame([(None, 7, 4.0), (None, 8, 1.0), (5, 8, 3.0), (6, 9, 1.0)], "user long, near long, rating double")
    got = pairs.listed_sums(own, "item", "near", "weight", rows, "user", "rating", block_rows=1, at_once=at_once)
    assert {(r.item, r.user): r.top for r in got.collect()} == {(1, None): 4.0, (1, 5): 6.0, (2, None): 1.0, (2, 5): 3.0}
