"""Run a query in Spark and its SQL twin in DuckDB and compare every value."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark"
    " labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = f"{folder}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


FAMILIES = {
    "bigint": "int", "int": "int", "smallint": "int", "tinyint": "int",
    "double": "float", "float": "float", "string": "text", "boolean": "bool", "date": "date",
    "timestamp": "ts", "timestamp_ntz": "ts",
    "BIGINT": "int", "INTEGER": "int", "SMALLINT": "int", "TINYINT": "int",
    "DOUBLE": "float", "FLOAT": "float", "VARCHAR": "text", "BOOLEAN": "bool", "DATE": "date",
    "TIMESTAMP": "ts",
}


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return value + 0.0
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def compare(spark, con, function, sql: str, folder: str) -> str | None:
    """None when both sides agree, else a description of the difference."""
    df = function(spark, folder)
    names = sorted(df.columns)
    kinds = {name: FAMILIES.get(kind, kind) for name, kind in df.dtypes}
    left = [tuple(_plain(row[name]) for name in names) for row in df.collect()]
    cursor = con.execute(sql)
    described = {d[0]: str(d[1]) for d in cursor.description}
    rows = cursor.fetchall()
    if sorted(described) != names:
        return f"columns {names} against {sorted(described)}"
    for name in names:
        if FAMILIES.get(described[name], described[name]) != kinds[name]:
            return f"type of {name}: {kinds[name]} against {described[name]}"
    at = [list(described).index(name) for name in names]
    right = [tuple(_plain(row[i]) for i in at) for row in rows]
    if len(left) != len(right):
        return f"{len(left)} rows against {len(right)}"
    a, b = Counter(left), Counter(right)
    if a != b:
        only_a, only_b = list((a - b).items())[:3], list((b - a).items())[:3]
        return f"{sum((a - b).values())} of {len(left)} rows differ: {only_a} against {only_b}"
    return None if left else "EMPTY"
