"""Logical views over the given parquet tables (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.sources.columns import TRANSACTIONS, map_columns


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").join(
        table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    """cust_id, product_id, revenue, ts: one row per order line."""
    return map_columns(order_lines(spark, folder), TRANSACTIONS)


# Action codes of the event log.
ACTIONS = {"view": 1, "click": 2, "error": 3, "signup": 4, "purchase": 5}


def activity(spark: SparkSession, folder: str) -> DataFrame:
    """event_id, cust_id, product_id, action_type, ts: one row per event."""
    code = F.lit(None).cast("int")
    for name, value in ACTIONS.items():
        code = F.when(F.col("event_type") == name, F.lit(value)).otherwise(code)
    return table(spark, folder, "events").select(
        "event_id",
        F.col("user_id").alias("cust_id"),
        F.get_json_object("props", "$.k").cast("long").alias("product_id"),
        code.alias("action_type"),
        "ts",
    )


def ratings(spark: SparkSession, folder: str) -> DataFrame:
    """user_id, item_id, rating (1..5): unique pairs."""
    stars = F.col("l_quantity").cast("int") % 5 + 1
    return (
        order_lines(spark, folder)
        .groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"))
        .agg(F.max(stars).cast("double").alias("rating"))
    )


def item_names(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("title"))


def regression_rows(spark: SparkSession, folder: str) -> DataFrame:
    """y with three predictors and the columns that order the rows."""
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.col("l_extendedprice").alias("y"),
        F.col("l_quantity").alias("x1"),
        F.col("l_tax").alias("x2"),
        F.col("l_discount").alias("x3"),
    )


REGRESSION_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "y"]


def paired(spark: SparkSession, folder: str) -> DataFrame:
    """Two measures per order: its price in thousands and the balance of its customer."""
    orders = table(spark, folder, "orders")
    customer = table(spark, folder, "customer")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", (F.col("o_totalprice") / 1000).alias("a"), F.col("c_acctbal").alias("b")
    )


def scored(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("label"), F.col("l_discount").alias("score")
    )


def series(spark: SparkSession, folder: str) -> DataFrame:
    """ticker, date, price: one row per ticker and day."""
    return (
        table(spark, folder, "orders")
        .groupBy(F.col("o_orderpriority").alias("ticker"), F.to_date("o_orderdate").alias("date"))
        .agg(F.avg("o_totalprice").alias("price"))
    )


def macro_tables(spark: SparkSession, folder: str) -> list[DataFrame]:
    """Five series keyed by the first day of their period: four monthly, one quarterly."""
    orders = table(spark, folder, "orders")
    lines = table(spark, folder, "lineitem")
    month = F.to_date(F.trunc("o_orderdate", "month")).alias("date")
    ship = F.to_date(F.trunc("l_shipdate", "month")).alias("date")
    quarter = F.to_date(F.date_trunc("quarter", "o_orderdate")).alias("date")
    return [
        orders.groupBy(month).agg(F.avg("o_totalprice").alias("mean_order_price")),
        orders.groupBy(month).agg(F.count(F.lit(1)).alias("order_count")),
        lines.groupBy(ship).agg(F.avg("l_discount").alias("mean_discount")),
        lines.groupBy(ship).agg(F.avg("l_quantity").alias("mean_quantity")),
        orders.groupBy(quarter).agg(F.sum("o_totalprice").alias("quarter_spend")),
    ]


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", "text", "lang")


def clusters(spark: SparkSession, folder: str) -> DataFrame:
    """Two labelings of the same vectors."""
    return table(spark, folder, "embeddings").select(
        "vec_id", F.col("label").alias("a"), (F.col("vec_id") % 10).cast("int").alias("b")
    )


def nation_links(spark: SparkSession, folder: str) -> DataFrame:
    """Undirected weighted links src < dst: order lines between a customer's and a supplier's nation."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_suppkey")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    supplier = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .filter(F.col("c_nationkey") != F.col("s_nationkey"))
        .groupBy(
            F.least("c_nationkey", "s_nationkey").alias("src"),
            F.greatest("c_nationkey", "s_nationkey").alias("dst"),
        )
        .agg(F.count(F.lit(1)).alias("w"))
    )
