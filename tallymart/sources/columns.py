"""Logical column names over physical ones: one plain dictionary per table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def map_columns(df: DataFrame, column_map: dict[str, str], wanted: list[str] | None = None) -> DataFrame:
    """Select the wanted logical columns; ``column_map`` is logical -> physical.

    A plain projection, so pruning reaches the scan.
    """
    names = wanted or list(column_map)
    return df.select(*(F.col(column_map[name]).alias(name) for name in names))


# Column maps of the two activity logs over the test tables.
TRANSACTIONS = {
    "cust_id": "o_custkey",
    "product_id": "l_partkey",
    "revenue": "l_extendedprice",
    "ts": "o_orderdate",
}
ORDER_LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
