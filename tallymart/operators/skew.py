"""Joins that stay balanced when one key holds a large part of all rows.

Spark splits skewed partitions of a sort-merge join only when both inputs come straight from a
shuffle. A side that has just been aggregated on the join key does not, so the helpers here spread
hot keys explicitly. A key is hot above ``hot_rows`` rows; hence there are at most
``rows / hot_rows`` of them and the broadcast list of hot keys is bounded by construction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000


def _parts(count: str, hot_rows: int) -> Column:
    """Number of tasks a key with ``count`` rows is spread over; 1 unless the key is hot."""
    return F.when(F.col(count) > hot_rows, F.ceil(F.col(count) / hot_rows)).otherwise(1).cast("int")


def _spread(rows: DataFrame, counts: DataFrame, keys: list[str], count: str, hot_rows: int) -> DataFrame:
    """Give every row of a hot key one of the key's salts. The salt is a hash of the whole row, so a
    repeated task gives the same answer."""
    hot = counts.filter(F.col(count) > hot_rows).select(*keys, _parts(count, hot_rows).alias("_parts"))
    salt = F.pmod(F.xxhash64(*rows.columns), F.coalesce("_parts", F.lit(1))).cast("int")
    return rows.join(F.broadcast(hot), keys, "left").withColumn("_salt", salt).drop("_parts")


def salted_join(
    rows: DataFrame,
    table: DataFrame,
    keys: list[str],
    how: str = "inner",
    hot_rows: int = HOT_ROWS,
    count: str | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Join ``rows`` to ``table`` (one row per key), spreading every hot key over several tasks.

    ``how`` is ``inner`` or ``left``. ``count`` names a column of ``table`` that already holds the
    number of ``rows`` per key; without it the keys are counted first. Where ``table`` is costly,
    ``counts`` may name a cheaper source of the same numbers.
    """
    if count:
        counts, known = (table if counts is None else counts).select(*keys, count), table
    else:
        count = "_n"
        counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(count))
        hot = counts.filter(F.col(count) > hot_rows)
        known = table.join(F.broadcast(hot), keys, "left")
    copies = known.withColumn("_salt", F.explode(F.sequence(F.lit(0), _parts(count, hot_rows) - 1)))
    if count == "_n":
        copies = copies.drop("_n")
    spread = _spread(rows, counts, keys, count, hot_rows)
    return spread.join(copies, [*keys, "_salt"], how).drop("_salt")


def attach_totals(
    rows: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS, **totals: Column
) -> DataFrame:
    """Put per-key aggregates beside every row: the aggregate is combined map-side and joined back,
    so no task ever holds a whole group (a window over the key would)."""
    table = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows"), *(column.alias(name) for name, column in totals.items())
    )
    return salted_join(rows, table, keys, "inner", hot_rows, count="_rows").drop("_rows")


def one_row(df: DataFrame) -> Column:
    """A one-row result as a struct value for use in another query: a scalar subquery, not a join."""
    return df.select(F.struct(*df.columns)).scalar()
