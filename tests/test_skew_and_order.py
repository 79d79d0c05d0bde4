"""Hot keys, blocks and total orders against brute force, with limits small enough to bite."""

import random
from collections import Counter, defaultdict
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tallymart.operators import ordering, pairs, relational, skew


@pytest.fixture(scope="module")
def rows():
    """A third of the rows have key 0."""
    rng = random.Random(7)
    return [(0 if i % 3 == 0 else rng.randrange(1, 40), i, rng.randrange(100)) for i in range(900)]


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "k int, i int, v int").repartition(5)


def test_salted_join_keeps_every_row(spark, df, rows):
    table = spark.createDataFrame([(k, k * 10) for k in range(0, 30)], "k int, w int")
    got = Counter(tuple(r) for r in skew.salted_join(df, table, ["k"], hot_rows=20).select("k", "i", "w").collect())
    assert got == Counter((k, i, k * 10) for k, i, _ in rows if k < 30)
    left = skew.salted_join(df, table, ["k"], "left", hot_rows=20)
    assert left.count() == len(rows)
    assert left.filter("w is null").count() == sum(k >= 30 for k, _, _ in rows)


def test_salted_join_spreads_the_hot_key(df):
    counts = df.groupBy("k").agg(F.count("*").alias("_n"))
    spread = skew._spread(df, counts, ["k"], "_n", 20)
    salts = spread.filter("k = 0").groupBy("_salt").count().collect()
    assert len(salts) == 15 and max(r["count"] for r in salts) < 60


@pytest.mark.parametrize("hot_rows", [20, 10_000])
def test_attach_totals(df, rows, hot_rows):
    sums = defaultdict(int)
    for k, _, v in rows:
        sums[k] += v
    got = skew.attach_totals(df, ["k"], hot_rows, total=F.sum("v")).collect()
    assert Counter((r.k, r.i, r.total) for r in got) == Counter((k, i, sums[k]) for k, i, _ in rows)


def test_positions_and_running_totals(df, rows):
    order = [F.col("v"), F.col("i")]
    numbered = {r.i: r.row_no for r in ordering.number_rows(df, order).collect()}
    wanted = sorted(rows, key=lambda r: (r[2], r[1]))
    assert numbered == {i: at for at, (_, i, _) in enumerate(wanted, start=1)}
    running = {r.i: r.upto for r in ordering.running_totals(df, order, upto="v").collect()}
    total = 0
    for _, i, v in wanted:
        total += v
        assert running[i] == total


@pytest.mark.parametrize("block_rows", [2, 5, 1000])
def test_member_pairs_match_brute_force(spark, block_rows):
    rng = random.Random(3)
    cells = {(g, m): float(rng.randrange(1, 6)) for g in range(12) for m in range(25) if rng.random() < 0.4 or g == 0}
    frame = spark.createDataFrame([(g, m, v) for (g, m), v in cells.items()], "g int, m int, v double")
    got = Counter(
        tuple(r) for r in pairs.member_pairs(frame, "g", "m", "v", block_rows, hot_rows=6).select("group", "a", "b", "x", "y").collect()
    )
    groups = defaultdict(list)
    for (g, m), _ in cells.items():
        groups[g].append(m)
    wanted = Counter(
        (g, a, b, cells[g, a], cells[g, b]) for g, ms in groups.items() for a, b in combinations(sorted(ms), 2)
    )
    assert got == wanted


def test_mirror(spark):
    one = spark.createDataFrame([(1, 2, 0.5, 3)], "a int, b int, d double, n int")
    got = {tuple(r) for r in pairs.mirror(one, negate=["d"]).collect()}
    assert got == {(1, 2, 0.5, 3), (2, 1, -0.5, 3)}


@pytest.mark.parametrize("k", [3, 7, 1000])
def test_contiguous_folds(df, rows, k):
    folds = {r.i: r.fold for r in relational.contiguous_folds(df, [F.col("i")], k).collect()}
    size, extra = divmod(len(rows), k)
    wanted, at = {}, 0
    for fold in range(1, k + 1):
        for _ in range(size + (fold <= extra)):
            wanted[at] = fold
            at += 1
    assert folds == wanted


def test_exact_quantiles_by_group(df, rows):
    groups = defaultdict(list)
    for k, _, v in rows:
        groups[k].append(v)
    got = relational.exact_quantiles(df, "v", {"q": 0.3}, ["k"]).collect()
    for r in got:
        values = sorted(groups[r.k])
        at = (len(values) - 1) * 0.3
        low = int(at)
        high = min(low + 1, len(values) - 1)
        assert r.q == pytest.approx(values[low] + (values[high] - values[low]) * (at - low))
    assert len(got) == len(groups)


def test_tie_ranks(df, rows):
    values = sorted(v for _, _, v in rows)
    for r in relational.tie_ranks(df, "v").collect():
        places = [i for i, v in enumerate(values, start=1) if v == r.v]
        assert r.avg_rank == pytest.approx(sum(places) / len(places))


def test_dense_codes_leave_nulls_out(spark):
    frame = spark.createDataFrame([("b",), (None,), ("a",), ("b",)], "k string")
    assert {tuple(r) for r in relational.dense_codes(frame, "k").collect()} == {("a", 0), ("b", 1)}


def test_histogram_closes_the_last_bin_and_keeps_empty_ones(spark):
    frame = spark.createDataFrame([(0.0,), (0.1,), (8.0,)], "v double")
    assert [r.n for r in relational.histogram(frame, "v", 8).orderBy("bin").collect()] == [2, 0, 0, 0, 0, 0, 0, 1]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_per_group_is_limited_before_the_shuffle(df):
    for ranked in (
        ordering.top_per_group(df, ["k"], [F.desc("v"), F.asc("i")], 3),
        relational.user_first_n(df, "k", [F.col("i")], 2, 4),
    ):
        text = plan(ranked)
        assert "WindowGroupLimit" in text and "Partial" in text
    got = {(r.k, r.i) for r in ordering.top_per_group(df, ["k"], [F.desc("v"), F.asc("i")], 3).collect()}
    assert len(got) == sum(min(3, n) for n in Counter(r.k for r in df.collect()).values())


def test_first_rows_of_each_user_and_the_cap(spark):
    rows = spark.createDataFrame([(u, 10 * p + u) for p in range(6) for u in range(3)], "u int, at int")
    test = relational.user_first_n(rows, "u", [F.col("at")], 2, 3, cap=4).orderBy("at")
    assert [(r.u, r.user_row) for r in test.collect()] == [(0, 2), (1, 2), (2, 2), (0, 3)]
    assert relational.complement(rows, test, ["at"]).count() == 14
