"""Scans and sinks. The delimited, text and JSON inputs are written by Spark from the given tables
into the shared folder first, so every scan grows with the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.plans.registry import EV, TX, query
from tallymart.session import scratch_path
from tallymart.sources import readers, sinks, tables
from tallymart.sources.columns import TRANSACTIONS, map_columns

ORDER_SCHEMA = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string"
ORDER_COLUMNS = [part.split(" ")[0] for part in ORDER_SCHEMA.split(", ")]


def _export(df: DataFrame, label: str, header: bool = True, **options: str) -> str:
    path = scratch_path(df.sparkSession, label)
    df.write.options(header=header, **options).csv(path)
    return path


@query("csv_scan", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def csv_scan(spark: SparkSession, folder: str) -> DataFrame:
    path = _export(tables.table(spark, folder, "orders").select(*ORDER_COLUMNS), "orders-pipe", sep="|")
    return readers.read_delimited(
        spark, path, ORDER_SCHEMA, sep="|", columns=["o_orderkey", "o_custkey", "o_totalprice"]
    )


@query("csv_scan_multichar", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def csv_scan_multichar(spark: SparkSession, folder: str) -> DataFrame:
    path = _export(tables.table(spark, folder, "orders").select(*ORDER_COLUMNS), "orders-colon", False, sep="::")
    return readers.read_delimited(
        spark, path, ORDER_SCHEMA, sep="::", header=False, columns=["o_orderkey", "o_custkey", "o_totalprice"]
    )


@query("column_map_scan", f"WITH {TX} SELECT cust_id, product_id, revenue FROM tx")
def column_map_scan(spark: SparkSession, folder: str) -> DataFrame:
    return map_columns(tables.order_lines(spark, folder), TRANSACTIONS, ["cust_id", "product_id", "revenue"])


@query("headerless_scan", f"WITH {EV} SELECT cust_id AS user_id, product_id AS item_id, action_type FROM ev")
def headerless_scan(spark: SparkSession, folder: str) -> DataFrame:
    rows = tables.activity(spark, folder).select("cust_id", "product_id", "action_type")
    path = _export(rows, "events-tab", header=False, sep="\t")
    return readers.read_delimited(
        spark, path, "user_id long, item_id long, action_type int", sep="\t", header=False
    )


@query("skip_header_lines", f"WITH {TX} SELECT cust_id, product_id, revenue FROM tx")
def skip_header_lines(spark: SparkSession, folder: str) -> DataFrame:
    rows = tables.transactions(spark, folder).select("cust_id", "product_id", "revenue")
    path = _export(rows, "transactions")
    return readers.read_delimited(spark, path, "cust_id long, product_id long, revenue double")


@query("sql_table_fetch", f"WITH {TX} SELECT cust_id, product_id, revenue, CAST(ts AS DATE) AS day FROM tx")
def sql_table_fetch(spark: SparkSession, folder: str) -> DataFrame:
    tables.transactions(spark, folder).createOrReplaceTempView("transaction_master")
    return readers.read_table(spark, "transaction_master").select(
        "cust_id", "product_id", "revenue", F.to_date("ts").alias("day")
    )


@query(
    "null_markers",
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS price, "
    "nullif(o_orderpriority, '1-URGENT') AS priority FROM orders",
)
def null_markers(spark: SparkSession, folder: str) -> DataFrame:
    orders = tables.table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", ".").otherwise(F.col("o_totalprice").cast("string")).alias("price"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "NULL").otherwise(F.col("o_orderpriority")).alias("priority"),
    )
    path = _export(orders, "orders-marked", sep=";")
    marked = readers.read_delimited(
        spark, path, "o_orderkey long, price double, priority string", sep=";", null_value="."
    )
    return marked.withColumn("priority", F.nullif("priority", F.lit("NULL")))


@query(
    "quoted_semicolon_scan",
    "SELECT p_partkey, p_name || '; \"' || p_brand || '\"' AS title, p_type AS author FROM part",
)
def quoted_semicolon_scan(spark: SparkSession, folder: str) -> DataFrame:
    part = tables.table(spark, folder, "part").select(
        "p_partkey",
        F.concat("p_name", F.lit('; "'), "p_brand", F.lit('"')).alias("title"),
        F.col("p_type").alias("author"),
    )
    path = _export(part, "books", sep=";", quoteAll="true", escape='"', encoding="ISO-8859-1")
    return readers.read_delimited(
        spark, path, "p_partkey long, title string, author string", sep=";", encoding="ISO-8859-1"
    )


@query(
    "json_listing_flatten",
    "SELECT o_orderpriority || ' ' || CAST(o_orderkey AS VARCHAR) AS title, 't3_' || CAST(o_orderkey AS VARCHAR) AS name FROM orders",
)
def json_listing_flatten(spark: SparkSession, folder: str) -> DataFrame:
    posts = tables.table(spark, folder, "orders").select(
        "o_custkey",
        F.struct(
            F.struct(
                F.concat_ws(" ", "o_orderpriority", "o_orderkey").alias("title"),
                F.concat(F.lit("t3_"), "o_orderkey").alias("name"),
            ).alias("data")
        ).alias("child"),
        (F.col("o_orderkey") % 25).alias("slot"),
        F.floor(F.col("o_orderkey") / 25).alias("page"),
    )
    # pages of at most 25 posts, as the listing format has them
    pages = posts.groupBy("page").agg(F.collect_list("child").alias("children"))
    path = scratch_path(spark, "listing")
    pages.select(F.struct(F.col("page").cast("string").alias("after"), "children").alias("data")).write.json(path)
    return readers.read_listing(spark, path)


@query(
    "json_field_scan",
    "SELECT event_id, CAST(regexp_extract(props, '\"k\": *([0-9]+)', 1) AS BIGINT) AS k FROM events",
)
def json_field_scan(spark: SparkSession, folder: str) -> DataFrame:
    return tables.table(spark, folder, "events").select(
        "event_id", F.get_json_object("props", "$.k").cast("long").alias("k")
    )


@query(
    "text_lines_scan",
    "SELECT unnest(string_split(text, chr(10))) AS value FROM documents",
)
def text_lines_scan(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "lines")
    tables.documents(spark, folder).select("text").write.option("lineSep", "\n").text(path)
    return readers.read_lines(spark, path)


@query("csv_sink", f"WITH {TX} SELECT cust_id, product_id, 1 AS rating FROM tx")
def csv_sink(spark: SparkSession, folder: str) -> DataFrame:
    rows = tables.transactions(spark, folder).select("cust_id", "product_id", F.lit(1).alias("rating"))
    path = scratch_path(spark, "training")
    sinks.write_csv(rows, path)
    return readers.read_delimited(spark, path, "cust_id long, product_id long, rating int")


@query(
    "csv_sink_append",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'O' "
    "UNION ALL SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus <> 'O'",
)
def csv_sink_append(spark: SparkSession, folder: str) -> DataFrame:
    orders = tables.table(spark, folder, "orders")
    path = scratch_path(spark, "appended")
    is_open = F.col("o_orderstatus") == "O"
    sinks.write_csv(orders.filter(is_open).select("o_orderkey", "o_custkey"), path)
    sinks.write_csv(orders.filter(~is_open).select("o_orderkey", "o_custkey"), path, mode="append")
    return readers.read_delimited(spark, path, "o_orderkey long, o_custkey long")


@query(
    "table_sink",
    "SELECT o_custkey AS cust_id, count(*) AS orders, round(sum(o_totalprice), 2) AS spend FROM orders GROUP BY 1",
)
def table_sink(spark: SparkSession, folder: str) -> DataFrame:
    spend = (
        tables.table(spark, folder, "orders")
        .groupBy(F.col("o_custkey").alias("cust_id"))
        .agg(F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("spend"))
    )
    path = scratch_path(spark, "spend")
    name = "customer_spend_" + path.rsplit("-", 1)[1][:12]
    sinks.write_table(spend, name, path)
    return readers.read_table(spark, name)


@query(
    "labelled_text_sink",
    r"SELECT lang AS label, regexp_replace(text, '[\r\n]+', ' ', 'g') AS value FROM documents",
)
def labelled_text_sink(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "labelled")
    sinks.write_labelled_text(tables.documents(spark, folder), path, label="lang")
    return spark.read.text(path).select(F.col("label"), "value")
