"""Positions and running totals over a total order, without a one-partition window.

Rows are range-partitioned by the order, numbered inside their partition, and written through to the
shared folder so that the numbers cannot change on a retry. Only one row per partition is needed to
turn local numbers into global ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tallymart.session import write_through

LOCAL_BITS = 33


def _ranged(df: DataFrame, order: list[Column]) -> DataFrame:
    numbered = df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id())
    return write_through(numbered, "ordered").withColumn("_part", F.shiftright("_mid", LOCAL_BITS))


def _offsets(parts: DataFrame, columns: list[str]) -> DataFrame:
    """Exclusive prefix sums over the partitions: as many rows as there are shuffle partitions."""
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select(
        "_part", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_off_{c}") for c in columns)
    )


def number_rows(df: DataFrame, order: list[Column], name: str = "row_no") -> DataFrame:
    """Add the 1-based position of each row in ``order`` (give a total order)."""
    fixed = _ranged(df, order)
    sizes = fixed.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))
    local = F.col("_mid") - F.shiftleft(F.col("_part"), LOCAL_BITS)
    return (
        fixed.join(F.broadcast(_offsets(sizes, ["n"])), "_part")
        .withColumn(name, (local + F.col("_off_n") + 1).cast("long"))
        .drop("_mid", "_part", "_off_n")
    )


def running_totals(df: DataFrame, order: list[Column], **sums: str) -> DataFrame:
    """Inclusive running sums in ``order``: keyword = output column, value = input column."""
    fixed = _ranged(df, order)
    sizes = fixed.groupBy("_part").agg(*(F.sum(c).alias(name) for name, c in sums.items()))
    upto = Window.partitionBy("_part").orderBy("_mid").rowsBetween(Window.unboundedPreceding, 0)
    out = fixed.join(F.broadcast(_offsets(sizes, list(sums))), "_part")
    return out.select(
        *df.columns,
        *((F.sum(c).over(upto) + F.col(f"_off_{name}")).alias(name) for name, c in sums.items()),
    )


def lagged(df: DataFrame, order: list[Column], steps: int = 1, within: tuple[str, ...] = (), **names: str) -> DataFrame:
    """Add values of the row ``steps`` before in ``order`` (a total order): keyword = output column, value = input.

    With ``within`` rows are ordered by these columns first and a value never comes from another group of them. A group
    may be of any size: the rows are range-partitioned once, a task hands the last ``steps`` rows of a batch on to the
    next batch, and the first rows of each partition get theirs from the last rows of the partitions before, which are
    at most ``steps`` for each. Null where there is no such row; the frame must not have columns ``_part`` and ``_no``.
    """
    sources = [*dict.fromkeys([*within, *names.values()])]
    lags = [f"_lag_{i}" for i in range(len(sources))]
    fields = [StructField(name, df.schema[c].dataType) for name, c in zip(lags, sources)]
    schema = StructType([*df.schema, StructField("_part", IntegerType()), *fields, StructField("_no", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried, done = None, 0
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            values = rows.select(sources)
            if carried is None:
                carried = pa.table({f.name: pa.nulls(steps, f.type) for f in values.schema}, schema=values.schema)
            chain = pa.concat_tables([carried, values])
            for name, c in zip(lags, sources):
                rows = rows.append_column(name, chain.column(c).slice(0, len(batch)))
            rows = rows.append_column("_no", pa.array(np.arange(done, done + len(batch)), pa.int64()))
            done += len(batch)
            carried = pa.Table.from_pylist(chain.slice(len(batch)).to_pylist(), schema=values.schema)
            yield from rows.combine_chunks().to_batches()

    placed = df.orderBy(*within, *order).withColumn("_part", F.spark_partition_id())
    fixed = write_through(placed.mapInArrow(run, schema), "lagged")
    sizes = fixed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    border = fixed.join(F.broadcast(sizes), "_part").filter((F.col("_no") < steps) | (F.col("_no") >= F.col("_size") - steps))
    chain = Window.orderBy("_part", "_no")  # at most 2 * steps rows of each partition
    heads = border.select(
        "_part", "_no", F.struct(*(F.lag(c, steps).over(chain).alias(name) for name, c in zip(lags, sources))).alias("_head")
    ).filter(F.col("_no") < steps)
    joined = fixed.join(F.broadcast(heads), ["_part", "_no"], "left")
    first = F.col("_no") < steps
    value = {c: F.when(first, F.col("_head")[name]).otherwise(F.col(name)) for name, c in zip(lags, sources)}
    same = F.lit(True)
    for c in within:
        same = same & value[c].eqNullSafe(F.col(c))
    return joined.select(*df.columns, *(F.when(same, value[c]).alias(name) for name, c in names.items()))


def top_per_group(df: DataFrame, group: list[str], order: list[Column], n: int, name: str = "rank") -> DataFrame:
    """First ``n`` rows of every group. The rank filter is pushed below the shuffle by Spark's window
    group limit, so a hot group sends at most ``n`` rows per map task."""
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= n)
