"""Registry of the named queries and, where SQL can say it, their SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function

    return add


# ---- SQL of the logical views ----------------------------------------------------------------

TX = """tx AS (
  SELECT o_custkey AS cust_id, l_partkey AS product_id, l_extendedprice AS revenue, o_orderdate AS ts
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

EV = """ev AS (
  SELECT event_id, user_id AS cust_id, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS product_id,
    CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'error' THEN 3 WHEN 'signup' THEN 4
      WHEN 'purchase' THEN 5 END AS action_type, ts
  FROM events)"""

RATINGS = """ratings AS (
  SELECT o_custkey AS user_id, l_partkey AS item_id,
    CAST(max(CAST(l_quantity AS INTEGER) % 5 + 1) AS DOUBLE) AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)"""

SERIES = """series AS (
  SELECT o_orderpriority AS ticker, CAST(o_orderdate AS DATE) AS date, avg(o_totalprice) AS price
  FROM orders GROUP BY 1, 2)"""

REG = """reg AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice AS y, l_quantity AS x1,
    l_tax AS x2, l_discount AS x3 FROM lineitem)"""
