"""Exact duplicates with a heavy-hitter split.

A Misra-Gries summary (Spark's ``approx_top_k``, a frequent-items sketch of that family) names at most
``tracked`` digests that can hold many rows. Their exact sizes and winners are worked out with a
map-side combine, and only the winners, at most ``top`` short rows, are broadcast: a row with a heavy
digest is decided where it was read. Every other digest holds a bounded share of the rows, so
the ordinary shuffle by digest has no hot key.

Defined results: null text counts as empty; a null id loses against any other; equal rows with equal
ids are told apart by their place in the input, one of them stays; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.llm.rows import ROW_KEY, with_row_key, without_row_key
from tallymart.session import write_through

WHITESPACE = " \t\n\x0b\x0c\r"


def normalised(text: Column) -> Column:
    """The text without its ASCII white space."""
    out = F.coalesce(text, F.lit(""))
    for char in WHITESPACE:
        out = F.replace(out, F.lit(char), F.lit(""))
    return out


def duplicate_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", top: int = 1000, tracked: int = 4096
) -> DataFrame:
    """One row per input row: its row key, ``id``, ``keep_id``, ``group_size``, ``kept``, ``digest``.

    Of equal texts the one with the most code points stays, then the smallest id.
    """
    keyed = with_row_key(docs).select(*ROW_KEY, id_col, text_col)
    text = F.col(text_col)
    rows = write_through(
        keyed.select(
            *ROW_KEY,
            F.col(id_col).alias("id"),
            F.length(F.coalesce(text, F.lit(""))).alias("points"),
            F.sha2(normalised(text).cast("binary"), 256).alias("digest"),
        ),
        "digests",
    )
    order = F.struct(-F.col("points"), F.col("id").isNull(), "id", *ROW_KEY)
    suspects = rows.agg(F.expr(f"approx_top_k(digest, {top}, {tracked})").alias("found")).select(
        F.explode("found.item").alias("digest")
    )
    heavy = (
        rows.join(F.broadcast(suspects), "digest", "left_semi")
        .groupBy("digest")
        .agg(F.min(order).alias("best"), F.count(F.lit(1)).alias("group_size"))
        .filter("group_size > 1")
    )
    marked = rows.join(F.broadcast(heavy), "digest", "left")
    group = Window.partitionBy("digest")
    light = (
        marked.filter("best IS NULL")
        .drop("best", "group_size")
        .withColumn("best", F.min(order).over(group))
        .withColumn("group_size", F.count(F.lit(1)).over(group))
    )
    both = marked.filter("best IS NOT NULL").unionByName(light)
    same = [F.col(f"best.{name}") == F.col(name) for name in ROW_KEY]
    return both.select(
        *ROW_KEY,
        "id",
        F.col("best.id").alias("keep_id"),
        "group_size",
        (same[0] & same[1]).alias("kept"),
        "digest",
    )


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    keyed = with_row_key(docs)
    gone = duplicate_groups(keyed, id_col, text_col).filter("NOT kept").select(*ROW_KEY)
    return without_row_key(keyed.join(gone, ROW_KEY, "left_anti")).select(*(f"`{c}`" for c in docs.columns))
