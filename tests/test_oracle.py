"""Every registered query at the smallest scale: against SQL where there is a twin, else for rows."""

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
# at the smallest scale the band may hold no item pair
MAY_BE_EMPTY = {"similar_items_band"}


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_twin_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, name):
    problem = compare(spark, con, QUERIES[name], ORACLES[name], FOLDER)
    assert problem is None or (problem == "EMPTY" and name in MAY_BE_EMPTY), problem


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).limit(1).count() == 1


def test_entry(spark):
    assert entry.entry(spark).columns
