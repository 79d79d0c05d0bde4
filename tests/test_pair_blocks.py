"""Sums by pairs of blocks against the lists of partners, for any number of blocks and pairs at a time."""

import pytest

from tallymart.operators import neighbours, pair_blocks


def _ratings(spark, kinds="user_id long, item_id long, rating double"):
    cells = [(u, (i * 37) % 53 - 20, float((u * 3 + i * 7) % 5 + 1)) for u in range(25) for i in range(30) if i == 3 or (u * i + u) % 4 == 0]
    cells += [(u, 3_000_000_000, 2.0 + u % 3) for u in range(12)] + [(u, 77, 0.0) for u in range(5)] + [cells[4]]
    return spark.createDataFrame(cells, kinds)


def _found(df, *names):
    rows = {}
    for r in df.collect():
        assert (r[0], r[1]) not in rows
        rows[r[0], r[1]] = [r[n] for n in names]
    return rows


@pytest.mark.parametrize(("block_entries", "at_once"), [(10**9, 10**6), (20, 10**6), (20, 5)])
def test_blocks_give_what_lists_give(spark, monkeypatch, block_entries, at_once):
    ratings = _ratings(spark)
    real = pair_blocks.pair_rows
    cases = [
        (neighbours.item_correlation, ["users", "correlation"]),
        (neighbours.cosine_items, ["similarity"]),
        (neighbours.cosine_users, ["similarity"]),
        (neighbours.slope_one_deviations, ["deviation", "users"]),
    ]
    for function, names in cases:
        monkeypatch.setattr(pair_blocks, "pair_rows", lambda *a, **k: real(*a, **{**k, "block_entries": block_entries, "at_once": at_once}))
        by_blocks = function(ratings)
        assert "MapInArrow" in by_blocks._jdf.queryExecution().toString()
        monkeypatch.setattr(pair_blocks, "fits", lambda *a: False)
        by_lists = function(ratings)
        monkeypatch.undo()
        assert [(f.name, f.dataType) for f in by_blocks.schema] == [(f.name, f.dataType) for f in by_lists.schema]
        got, want = _found(by_blocks, *names), _found(by_lists, *names)
        assert got.keys() == want.keys() and all(a < b for a, b in got)
        for pair, values in want.items():
            assert got[pair] == pytest.approx(values, rel=1e-9, abs=1e-12)


def test_a_pair_is_not_shipped_with_the_totals_of_both(spark):
    plan = neighbours.item_correlation(_ratings(spark))._jdf.queryExecution().toString()
    assert "spread" not in plan and "raters" not in plan


def test_nulls_and_other_kinds_of_ids_go_by_lists(spark):
    ratings = _ratings(spark)
    assert pair_blocks.fits(ratings, "user_id", "item_id", "rating")
    for bad in ("(null, 1L, 2.0D)", "(1L, null, 2.0D)", "(1L, 1L, null)", "(1L, 1L, double('NaN'))"):
        more = ratings.unionByName(spark.sql(f"SELECT * FROM VALUES {bad} AS t(user_id, item_id, rating)"))
        assert not pair_blocks.fits(more, "user_id", "item_id", "rating")
    assert not pair_blocks.fits(ratings.withColumn("user_id", ratings.user_id.cast("string")), "user_id", "item_id", "rating")
    nothing = ratings.limit(0)
    for function in (neighbours.item_correlation, neighbours.cosine_items, neighbours.slope_one_deviations):
        assert function(nothing).collect() == []
