"""Projection, filter, join, aggregate, window and set queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.functions import scalar
from tallymart.operators import relational as rel
from tallymart.operators import retail, timeseries
from tallymart.operators.ordering import lagged, top_per_group
from tallymart.operators.relational import error_scores
from tallymart.plans.registry import EV, RATINGS, REG, SERIES, TX, query
from tallymart.sources import tables


def _tx(spark: SparkSession, folder: str) -> DataFrame:
    return tables.transactions(spark, folder)


# ---- projection, filter, expressions ---------------------------------------------------------


@query("project_cols", f"WITH {TX} SELECT cust_id, product_id FROM tx")
def project_cols(spark, folder):
    return _tx(spark, folder).drop("revenue", "ts")


@query("constant_rating", f"WITH {TX} SELECT cust_id, product_id, 1 AS rating FROM tx")
def constant_rating(spark, folder):
    return _tx(spark, folder).select("cust_id", "product_id", F.lit(1).alias("rating"))


@query(
    "recode_value",
    f"WITH {EV} SELECT event_id, CASE WHEN action_type = 3 THEN -1 ELSE action_type END AS rating FROM ev",
)
def recode_value(spark, folder):
    return tables.activity(spark, folder).select("event_id", rel.recode("action_type", {3: -1}).alias("rating"))


@query(
    "map_values",
    "SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 0 WHEN 'F' THEN 1 END AS code FROM orders",
)
def map_values(spark, folder):
    return tables.table(spark, folder, "orders").select(
        "o_orderkey", rel.lookup("o_orderstatus", {"O": 0, "F": 1}).alias("code")
    )


@query(
    "where_label",
    "SELECT o_orderkey, CASE WHEN o_totalprice > 150000 THEN 'large' ELSE 'small' END AS size FROM orders",
)
def where_label(spark, folder):
    size = F.when(F.col("o_totalprice") > 150000, "large").otherwise("small")
    return tables.table(spark, folder, "orders").select("o_orderkey", size.alias("size"))


@query(
    "filter_rows",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders "
    "WHERE o_orderstatus <> 'P' AND o_totalprice > 100000 AND o_totalprice <= 300000",
)
def filter_rows(spark, folder):
    return (
        tables.table(spark, folder, "orders")
        .filter("o_orderstatus != 'P'")
        .filter((F.col("o_totalprice") > 100000) & (F.col("o_totalprice") <= 300000))
        .select("o_orderkey", "o_custkey", "o_totalprice")
    )


@query("contains_filter", "SELECT p_partkey AS item_id, p_name AS title FROM part WHERE regexp_matches(p_name, 'red|ring')")
def contains_filter(spark, folder):
    return tables.item_names(spark, folder).filter(F.col("title").rlike("red|ring"))


@query(
    "isin_anti",
    f"WITH {TX} SELECT p_partkey AS item_id, p_name AS title FROM part "
    "WHERE p_partkey NOT IN (SELECT product_id FROM tx WHERE revenue > 90000)",
)
def isin_anti(spark, folder):
    taken = _tx(spark, folder).filter(F.col("revenue") > 90000).select(F.col("product_id").alias("item_id"))
    return tables.item_names(spark, folder).join(taken, "item_id", "left_anti")


@query(
    "range_filter",
    "SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE l_discount > 0.04 AND l_discount < 0.1",
)
def range_filter(spark, folder):
    return (
        tables.table(spark, folder, "lineitem")
        .filter((F.col("l_discount") > 0.04) & (F.col("l_discount") < 0.1))
        .select("l_orderkey", "l_linenumber", "l_discount")
    )


@query(
    "split_line",
    """SELECT o_orderkey, CAST(split_part(o_orderpriority, '-', 1) AS INTEGER) AS level,
      split_part(o_orderpriority, '-', 2) AS label, TRY_CAST(split_part(o_orderpriority, '-', 2) AS DOUBLE) AS numeric_label
    FROM orders""",
)
def split_line(spark, folder):
    parts = F.split("o_orderpriority", "-")
    return tables.table(spark, folder, "orders").select(
        "o_orderkey",
        parts.getItem(0).cast("int").alias("level"),
        parts.getItem(1).alias("label"),
        parts.getItem(1).try_cast("double").alias("numeric_label"),
    )


@query("strip_quotes", "SELECT p_partkey, p_name AS title FROM part")
def strip_quotes(spark, folder):
    quoted = F.concat(F.lit(' "'), "p_name", F.lit('" '))
    return tables.table(spark, folder, "part").select("p_partkey", scalar.strip_quotes(quoted).alias("title"))


@query(
    "concat_label",
    """SELECT c_custkey, c_name || ' by ' || c_mktsegment AS title,
      CASE WHEN c_acctbal < 0 THEN c_mktsegment
        ELSE c_mktsegment || ' (age: ' || CAST(CAST(floor(c_acctbal / 100) AS BIGINT) AS VARCHAR) || ')' END AS place
    FROM customer""",
)
def concat_label(spark, folder):
    age = F.when(F.col("c_acctbal") >= 0, F.floor(F.col("c_acctbal") / 100))
    place = F.when(age.isNull(), F.col("c_mktsegment")).otherwise(
        F.concat("c_mktsegment", F.lit(" (age: "), age.cast("string"), F.lit(")"))
    )
    return tables.table(spark, folder, "customer").select(
        "c_custkey", F.concat("c_name", F.lit(" by "), "c_mktsegment").alias("title"), place.alias("place")
    )


@query(
    "to_timestamp",
    "SELECT event_id, CAST(ts AS DATE) AS day, CAST(floor(epoch(ts)) AS BIGINT) AS seconds, "
    "CAST(extract(hour FROM ts) AS INTEGER) AS hour FROM events",
)
def to_timestamp(spark, folder):
    seconds = F.floor(scalar.micros("ts") / 1_000_000)
    return tables.table(spark, folder, "events").select(
        "event_id",
        F.to_date(F.to_timestamp(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), "yyyy-MM-dd HH:mm:ss")).alias("day"),
        seconds.alias("seconds"),
        F.hour(F.timestamp_seconds(seconds)).alias("hour"),
    )


@query(
    "day_diff",
    f"""WITH {EV} SELECT event_id, date_diff('day', CAST(ts AS DATE), DATE '2024-01-31') AS age_days,
      CAST(floor((epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(ts)) / 86400000000.0) AS BIGINT) AS whole_days
    FROM ev""",
)
def day_diff(spark, folder):
    as_of = F.lit("2024-01-31")
    return tables.activity(spark, folder).select(
        "event_id",
        F.datediff(as_of.cast("date"), F.to_date("ts")).cast("long").alias("age_days"),
        scalar.whole_days(as_of.cast("timestamp"), "ts").alias("whole_days"),
    )


@query("half_even_round", "SELECT l_orderkey, l_linenumber, l_suppkey, CAST(round_even(l_quantity / 2, 0) AS DOUBLE) AS half FROM lineitem")
def half_even_round(spark, folder):
    return tables.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", scalar.half_even(F.col("l_quantity") / 2).cast("double").alias("half")
    )


@query(
    "fill_null",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 0 ELSE o_totalprice END AS price,
      CASE WHEN o_orderstatus = 'P' THEN c_acctbal ELSE o_totalprice END AS price_or_balance
    FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def fill_null(spark, folder):
    known = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
    rows = tables.table(spark, folder, "orders").join(
        tables.table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    return rows.select(
        "o_orderkey", known.alias("price"), F.coalesce(known, "c_acctbal").alias("price_or_balance")
    ).na.fill(0.0, ["price"])


@query(
    "scalar_math",
    """SELECT c_custkey, abs(c_acctbal) AS magnitude, power(c_acctbal, 2) AS squared,
      round(sqrt(abs(c_acctbal)), 9) AS root, round(ln(abs(c_acctbal) + 1), 9) AS logged,
      round(exp(c_acctbal / 10000), 9) AS grown FROM customer""",
)
def scalar_math(spark, folder):
    balance = F.col("c_acctbal")
    return tables.table(spark, folder, "customer").select(
        "c_custkey",
        F.abs(balance).alias("magnitude"),
        F.pow(balance, F.lit(2)).alias("squared"),
        F.round(F.sqrt(F.abs(balance)), 9).alias("root"),
        F.round(F.log(F.abs(balance) + 1), 9).alias("logged"),
        F.round(F.exp(balance / 10000), 9).alias("grown"),
    )


# The words that item names are made of.
NAME_WORDS = [
    "anvil", "blue", "bolt", "cold", "gear", "gizmo", "hot", "large",
    "new", "old", "plate", "red", "ring", "rod", "small", "widget",
]


@query(
    "multi_hot",
    "SELECT p_partkey AS item_id, "
    + ", ".join(f"CAST(list_contains(string_split(p_name, ' '), '{w}') AS INTEGER) AS {w}" for w in NAME_WORDS)
    + " FROM part",
)
def multi_hot(spark, folder):
    return rel.multi_hot(tables.item_names(spark, folder), "title", NAME_WORDS).drop("title")


@query(
    "one_hot",
    "SELECT o_orderkey, CAST(o_orderstatus = 'O' AS INTEGER) AS status_O, CAST(o_orderstatus = 'P' AS INTEGER) AS status_P FROM orders",
)
def one_hot(spark, folder):
    orders = tables.table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return rel.one_hot(orders, "o_orderstatus", ["F", "O", "P"], "status").drop("o_orderstatus")


# Age and occupation codes of the rating users.
AGES = {
    1: "Under 18", 18: "18-24", 25: "25-34", 35: "35-44", 45: "45-49", 50: "50-55", 56: "56+",
}
OCCUPATIONS = {
    0: "other or not specified", 1: "academic/educator", 2: "artist", 3: "clerical/admin",
    4: "college/grad student", 5: "customer service", 6: "doctor/health care", 7: "executive/managerial",
    8: "farmer", 9: "homemaker", 10: "K-12 student", 11: "lawyer", 12: "programmer", 13: "retired",
    14: "sales/marketing", 15: "scientist", 16: "self-employed", 17: "technician/engineer",
    18: "tradesman/craftsman", 19: "unemployed", 20: "writer",
}


def _case(column: str, mapping: dict) -> str:
    body = " ".join(f"WHEN {k} THEN '{v}'" for k, v in mapping.items())
    return f"CASE {column} {body} END"


@query(
    "decode_dimension",
    f"""SELECT c_custkey AS user_id, {_case("c_nationkey", AGES)} AS age, {_case("c_nationkey", OCCUPATIONS)} AS occupation
    FROM customer""",
)
def decode_dimension(spark, folder):
    return tables.table(spark, folder, "customer").select(
        F.col("c_custkey").alias("user_id"),
        rel.lookup("c_nationkey", AGES).alias("age"),
        rel.lookup("c_nationkey", OCCUPATIONS).alias("occupation"),
    )


@query(
    "random_category",
    "SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'rural' WHEN 1 THEN 'suburban' ELSE 'urban' END AS area FROM orders",
)
def random_category(spark, folder):
    slot = F.pmod("o_orderkey", F.lit(3))
    area = F.when(slot == 0, "rural").when(slot == 1, "suburban").otherwise("urban")
    return tables.table(spark, folder, "orders").select("o_orderkey", area.alias("area"))


@query("random_category_seeded")
def random_category_seeded(spark, folder):
    orders = tables.table(spark, folder, "orders").select("o_orderkey")
    sized = rel.random_category(orders, [0.5], ["small", "large"], seed=12345, name="size")
    return rel.random_category(sized, [0.33, 0.66], ["rural", "suburban", "urban"], seed=123456, name="area")


# ---- joins -----------------------------------------------------------------------------------


@query(
    "inner_join",
    "SELECT o_orderkey, c_custkey, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey",
)
def inner_join(spark, folder):
    customer = tables.table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    orders = tables.table(spark, folder, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    return orders.join(customer, "c_custkey").select("o_orderkey", "c_custkey", "c_mktsegment")


@query(
    "inner_join_multi",
    f"""WITH {TX}, {EV}, e AS (SELECT cust_id, product_id, count(*) AS events FROM ev GROUP BY 1, 2)
    SELECT cust_id, product_id, revenue, events FROM tx JOIN e USING (cust_id, product_id)""",
)
def inner_join_multi(spark, folder):
    events = tables.activity(spark, folder).groupBy(*retail.PAIR).agg(F.count(F.lit(1)).alias("events"))
    return _tx(spark, folder).join(events, retail.PAIR).select(*retail.PAIR, "revenue", "events")


@query(
    "right_join",
    f"""WITH {TX}, {EV}, e AS (SELECT cust_id, product_id, count(*) AS events FROM ev GROUP BY 1, 2)
    SELECT cust_id, product_id, revenue, events FROM tx RIGHT JOIN e USING (cust_id, product_id)""",
)
def right_join(spark, folder):
    events = tables.activity(spark, folder).groupBy(*retail.PAIR).agg(F.count(F.lit(1)).alias("events"))
    return _tx(spark, folder).join(events, retail.PAIR, "right").select(*retail.PAIR, "revenue", "events")


MACRO = """m1 AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS date, avg(o_totalprice) AS mean_order_price, count(*) AS order_count
    FROM orders GROUP BY 1),
  m2 AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS date, avg(l_discount) AS mean_discount, avg(l_quantity) AS mean_quantity
    FROM lineitem GROUP BY 1),
  q AS (SELECT CAST(date_trunc('quarter', o_orderdate) AS DATE) AS date, sum(o_totalprice) AS quarter_spend FROM orders GROUP BY 1)"""


def _rounded_macro(spark, folder):
    return timeseries.align_on_date(tables.macro_tables(spark, folder)).select(
        "date",
        F.round("mean_order_price", 5).alias("mean_order_price"),
        "order_count",
        F.round("mean_discount", 9).alias("mean_discount"),
        F.round("mean_quantity", 9).alias("mean_quantity"),
        F.round("quarter_spend", 2).alias("quarter_spend"),
    )


MACRO_SQL = f"""WITH {MACRO}
  SELECT date, round(mean_order_price, 5) AS mean_order_price, order_count, round(mean_discount, 9) AS mean_discount,
    round(mean_quantity, 9) AS mean_quantity, round(quarter_spend, 2) AS quarter_spend
  FROM m1 JOIN m2 USING (date) JOIN q USING (date)"""


@query("chain_join_date", MACRO_SQL)
def chain_join_date(spark, folder):
    return _rounded_macro(spark, folder)


HEAVY = """cn AS (SELECT cust_id, count(*) AS n FROM {t} GROUP BY 1),
  ch AS (SELECT n, sum(count(*)) OVER (ORDER BY n DESC) AS running, sum(count(*)) OVER () AS total FROM cn GROUP BY n),
  hc AS (SELECT cust_id, n FROM cn WHERE n IN (SELECT n FROM ch WHERE running * 100 <= total * 90)),
  pn AS (SELECT product_id, count(*) AS n FROM {t} GROUP BY 1),
  ph AS (SELECT n, sum(count(*)) OVER (ORDER BY n DESC) AS running, sum(count(*)) OVER () AS total FROM pn GROUP BY n),
  hp AS (SELECT product_id, n FROM pn WHERE n IN (SELECT n FROM ph WHERE running * 100 <= total * 90))"""


@query(
    "semi_filter",
    f"""WITH {TX}, {HEAVY.format(t="tx")} SELECT cust_id, product_id, revenue FROM tx
    WHERE cust_id IN (SELECT cust_id FROM hc) AND product_id IN (SELECT product_id FROM hp)""",
)
def semi_filter(spark, folder):
    rows = _tx(spark, folder)
    return (
        rows.join(retail.heavy_keys(rows, "cust_id"), "cust_id", "left_semi")
        .join(retail.heavy_keys(rows, "product_id"), "product_id", "left_semi")
        .select("cust_id", "product_id", "revenue")
    )


@query(
    "anti_join",
    f"""WITH {TX}, {EV} SELECT DISTINCT cust_id, product_id FROM ev
    WHERE NOT EXISTS (SELECT 1 FROM tx WHERE tx.cust_id = ev.cust_id AND tx.product_id = ev.product_id)""",
)
def anti_join(spark, folder):
    seen = tables.activity(spark, folder).select(*retail.PAIR).distinct()
    return seen.join(_tx(spark, folder).select(*retail.PAIR), retail.PAIR, "left_anti")


@query(
    "decode_join",
    f"""WITH {TX}, c AS (SELECT cust_id, dense_rank() OVER (ORDER BY cust_id) - 1 AS code FROM (SELECT DISTINCT cust_id FROM tx) d),
      p AS (SELECT product_id, dense_rank() OVER (ORDER BY product_id) - 1 AS code FROM (SELECT DISTINCT product_id FROM tx) d)
    SELECT c.cust_id, c.code AS cust_code, p.product_id, p.code AS product_code, revenue
    FROM tx JOIN c ON tx.cust_id = c.cust_id JOIN p ON tx.product_id = p.product_id""",
)
def decode_join(spark, folder):
    rows = _tx(spark, folder)
    customers = rel.dense_codes(rows, "cust_id", "cust_code")
    products = rel.dense_codes(rows, "product_id", "product_code")
    coded = rows.join(customers, "cust_id").join(products, "product_id").select("cust_code", "product_code", "revenue")
    return coded.join(customers, "cust_code").join(products, "product_code").select(
        "cust_id", "cust_code", "product_id", "product_code", "revenue"
    )


# ---- aggregates ------------------------------------------------------------------------------


@query("group_count", f"WITH {TX} SELECT cust_id, count(product_id) AS n FROM tx GROUP BY 1")
def group_count(spark, folder):
    return _tx(spark, folder).groupBy("cust_id").agg(F.count("product_id").alias("n"))


@query("pair_count", f"WITH {TX} SELECT cust_id, product_id, count(*) AS counter FROM tx GROUP BY 1, 2")
def pair_count(spark, folder):
    return _tx(spark, folder).groupBy(*retail.PAIR).agg(F.count(F.lit(1)).alias("counter"))


@query(
    "count_of_counts",
    f"WITH {TX}, c AS (SELECT cust_id, count(*) AS n FROM tx GROUP BY 1) SELECT n, count(*) AS keys FROM c GROUP BY 1",
)
def count_of_counts(spark, folder):
    return retail.count_of_counts(_tx(spark, folder), "cust_id")


@query(
    "distinct_count",
    f"WITH {TX} SELECT count(DISTINCT cust_id) AS users, count(DISTINCT product_id) AS items FROM tx",
)
def distinct_count(spark, folder):
    return _tx(spark, folder).agg(
        F.count_distinct("cust_id").alias("users"), F.count_distinct("product_id").alias("items")
    )


@query(
    "min_max_span",
    f"""WITH {EV} SELECT cust_id, product_id, CAST(min(ts) AS DATE) AS first_day, CAST(max(ts) AS DATE) AS last_day,
      epoch_us(max(ts)) - epoch_us(min(ts)) AS span_us FROM ev GROUP BY 1, 2""",
)
def min_max_span(spark, folder):
    return (
        tables.activity(spark, folder)
        .groupBy(*retail.PAIR)
        .agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
        .select(
            *retail.PAIR,
            F.to_date("lo").alias("first_day"),
            F.to_date("hi").alias("last_day"),
            scalar.span_micros("hi", "lo").alias("span_us"),
        )
    )


@query("group_sum", f"WITH {TX} SELECT product_id, round(sum(revenue), 2) AS revenue FROM tx GROUP BY 1")
def group_sum(spark, folder):
    return _tx(spark, folder).groupBy("product_id").agg(F.round(F.sum("revenue"), 2).alias("revenue"))


@query(
    "group_distinct_customers",
    f"WITH {TX} SELECT product_id, count(DISTINCT cust_id) AS customers FROM tx GROUP BY 1",
)
def group_distinct_customers(spark, folder):
    return _tx(spark, folder).groupBy("product_id").agg(F.count_distinct("cust_id").alias("customers"))


@query(
    "group_mean",
    """SELECT o_orderpriority AS g, round(avg(o_totalprice), 5) AS mean,
      round(avg(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END), 5) AS open_mean FROM orders GROUP BY 1""",
)
def group_mean(spark, folder):
    open_price = F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice"))
    return (
        tables.table(spark, folder, "orders")
        .groupBy(F.col("o_orderpriority").alias("g"))
        .agg(
            F.round(F.avg("o_totalprice"), 5).alias("mean"),
            F.round(F.avg(open_price), 5).alias("open_mean"),
        )
    )


def _describe_sql(column: str, source: str, group: str = "") -> str:
    head = f"{group}, " if group else ""
    tail = f" GROUP BY {group}" if group else ""
    return f"""SELECT {head}'{column}' AS column_name, count({column}) AS n, round(avg({column}), 5) AS mean,
      round(stddev_samp({column}), 5) AS std, CAST(min({column}) AS DOUBLE) AS min, CAST(max({column}) AS DOUBLE) AS max,
      round(quantile_cont(CAST({column} AS DOUBLE), 0.25), 5) AS q25, round(quantile_cont(CAST({column} AS DOUBLE), 0.5), 5) AS q50,
      round(quantile_cont(CAST({column} AS DOUBLE), 0.75), 5) AS q75 FROM {source}{tail}"""


def _round_describe(df: DataFrame) -> DataFrame:
    for name in ("mean", "std", "q25", "q50", "q75"):
        df = df.withColumn(name, F.round(name, 5))
    return df


@query(
    "describe",
    " UNION ALL ".join(
        _describe_sql(c, "lineitem") for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    ),
)
def describe(spark, folder):
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return _round_describe(rel.describe(tables.table(spark, folder, "lineitem"), columns))


@query("group_describe", _describe_sql("o_totalprice", "orders", "o_orderpriority"))
def group_describe(spark, folder):
    orders = tables.table(spark, folder, "orders")
    return _round_describe(rel.describe(orders, ["o_totalprice"], ["o_orderpriority"]))


@query(
    "null_profile",
    """WITH d AS (SELECT documents.doc_id, quality, toxic FROM documents LEFT JOIN labels ON documents.doc_id = labels.doc_id),
      s AS (SELECT 'doc_id' AS column_name, sum(CAST(doc_id IS NULL AS INTEGER)) AS nulls FROM d
        UNION ALL SELECT 'quality', sum(CAST(quality IS NULL AS INTEGER)) FROM d
        UNION ALL SELECT 'toxic', sum(CAST(toxic IS NULL AS INTEGER)) FROM d)
    SELECT column_name, CAST(nulls AS BIGINT) AS nulls, nulls > 0 AS any_null FROM s""",
)
def null_profile(spark, folder):
    labelled = tables.documents(spark, folder).select("doc_id").join(
        tables.table(spark, folder, "labels"), "doc_id", "left"
    )
    return rel.null_profile(labelled.select("doc_id", "quality", "toxic"))


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query(
    "pivot_mean",
    "SELECT o_custkey, "
    + ", ".join(
        f"round(coalesce(avg(CASE WHEN o_orderpriority = '{p}' THEN o_totalprice END), 0), 5) AS \"{p}\"" for p in PRIORITIES
    )
    + " FROM orders GROUP BY 1",
)
def pivot_mean(spark, folder):
    wide = rel.pivot_mean(tables.table(spark, folder, "orders"), "o_custkey", "o_orderpriority", "o_totalprice", PRIORITIES)
    return wide.select("o_custkey", *(F.round(F.col(f"`{p}`"), 5).alias(p) for p in PRIORITIES))


@query(
    "sparsity",
    f"""WITH {RATINGS} SELECT count(DISTINCT user_id) AS users, count(DISTINCT item_id) AS items, count(*) AS cells,
      round(1 - count(*) / (count(DISTINCT user_id) * count(DISTINCT item_id)), 3) AS sparsity FROM ratings""",
)
def sparsity(spark, folder):
    return rel.sparsity(tables.ratings(spark, folder), "user_id", "item_id")


MOMENTS_SQL = """mu AS (SELECT avg({v}) AS m FROM {s}),
  pw AS (SELECT count(*) AS n, avg(power({v} - m, 2)) AS m2, avg(power({v} - m, 3)) AS m3, avg(power({v} - m, 4)) AS m4
    FROM {s}, mu)"""


@query(
    "moments",
    f"""WITH {MOMENTS_SQL.format(v="l_extendedprice", s="lineitem")}
    SELECT n, round(m3 / power(m2, 1.5), 8) AS skewness, round(m4 / (m2 * m2), 8) AS kurtosis FROM pw""",
)
def moments(spark, folder):
    return rel.moments(tables.table(spark, folder, "lineitem"), "l_extendedprice").select(
        "n", F.round("skewness", 8).alias("skewness"), F.round("kurtosis", 8).alias("kurtosis")
    )


@query(
    "mse_rmse",
    """SELECT l_returnflag, count(*) AS n, round(avg(power(l_quantity - l_extendedprice / 1500, 2)), 6) AS mse,
      round(sqrt(avg(power(l_quantity - l_extendedprice / 1500, 2))), 8) AS rmse FROM lineitem GROUP BY 1""",
)
def mse_rmse(spark, folder):
    lines = tables.table(spark, folder, "lineitem").withColumn("guess", F.col("l_extendedprice") / 1500)
    return error_scores(lines, "l_quantity", "guess", ["l_returnflag"]).select(
        "l_returnflag", "n", F.round("mse", 6).alias("mse"), F.round("rmse", 8).alias("rmse")
    )


@query(
    "category_share",
    "SELECT event_type, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 9) AS percent FROM events GROUP BY 1",
)
def category_share(spark, folder):
    return rel.category_share(tables.table(spark, folder, "events"), "event_type").withColumn(
        "percent", F.round("percent", 9)
    )


@query(
    "dedupe_first",
    f"""WITH {TX}, p AS (SELECT cust_id, product_id, count(*) AS counter FROM tx GROUP BY 1, 2),
      r AS (SELECT *, row_number() OVER (PARTITION BY cust_id ORDER BY product_id) AS rn FROM p)
    SELECT cust_id, product_id, counter FROM r WHERE rn = 1""",
)
def dedupe_first(spark, folder):
    pairs = _tx(spark, folder).groupBy(*retail.PAIR).agg(F.count(F.lit(1)).alias("counter"))
    return rel.dedupe_first(pairs, ["cust_id"], ["product_id"])


@query("distinct_rows", f"WITH {TX} SELECT DISTINCT cust_id, product_id, CAST(ts AS DATE) AS day FROM tx")
def distinct_rows(spark, folder):
    return _tx(spark, folder).select("cust_id", "product_id", F.to_date("ts").alias("day")).distinct()


# ---- windows, sorts, sets --------------------------------------------------------------------


@query(
    "cumulative_share",
    f"""WITH {TX}, c AS (SELECT cust_id, count(*) AS n FROM tx GROUP BY 1), h AS (SELECT n, count(*) AS keys FROM c GROUP BY 1)
    SELECT n, keys, CAST(sum(keys) OVER (ORDER BY n DESC) AS BIGINT) AS running, CAST(sum(keys) OVER () AS BIGINT) AS total FROM h""",
)
def cumulative_share(spark, folder):
    return retail.cumulative_share(retail.count_of_counts(_tx(spark, folder), "cust_id"), "n", "keys")


@query(
    "dense_code",
    f"""WITH {TX} SELECT product_id, dense_rank() OVER (ORDER BY product_id) - 1 AS code
    FROM (SELECT DISTINCT product_id FROM tx) d""",
)
def dense_code(spark, folder):
    return rel.dense_codes(_tx(spark, folder), "product_id")


@query(
    "rolling_mean",
    f"""WITH {SERIES} SELECT ticker, date, CASE WHEN count(price) OVER w = 20 THEN round(avg(price) OVER w, 6) END AS mean20
    FROM series WINDOW w AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)""",
)
def rolling_mean(spark, folder):
    rolled = timeseries.rolling_mean(tables.series(spark, folder), 20, "mean20")
    return rolled.select("ticker", "date", F.round("mean20", 6).alias("mean20"))


PANEL = f"""{SERIES}, days AS (SELECT date FROM
    (SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM series) WHERE isodow(date) < 6),
  spine AS (SELECT ticker, date FROM (SELECT DISTINCT ticker FROM series) k, days),
  panel AS (SELECT spine.ticker, spine.date, series.price FROM spine
    LEFT JOIN series ON series.ticker = spine.ticker AND series.date = spine.date)"""


@query(
    "forward_fill",
    f"""WITH {PANEL} SELECT ticker, date, round(last_value(price IGNORE NULLS) OVER
      (PARTITION BY ticker ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 5) AS price FROM panel""",
)
def forward_fill(spark, folder):
    filled = timeseries.forward_fill(timeseries.reindex(tables.series(spark, folder)))
    return filled.select("ticker", "date", F.round("price", 5).alias("price"))


@query(
    "lag_diff",
    f"""WITH {SERIES} SELECT ticker, date, round(price - lag(price) OVER (PARTITION BY ticker ORDER BY date), 5) AS change FROM series""",
)
def lag_diff(spark, folder):
    rows = lagged(tables.series(spark, folder), [F.col("date")], within=("ticker",), before="price")
    return rows.select("ticker", "date", F.round(F.col("price") - F.col("before"), 5).alias("change"))


@query(
    "rank_topn_per_group",
    f"""WITH {RATINGS}, r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY rating DESC, item_id) AS rank FROM ratings)
    SELECT user_id, item_id, rating, rank FROM r WHERE rank <= 5""",
)
def rank_topn_per_group(spark, folder):
    return top_per_group(tables.ratings(spark, folder), ["user_id"], [F.desc("rating"), F.asc("item_id")], 5)


@query(
    "avg_rank",
    """WITH d AS (SELECT abs(c_acctbal) AS magnitude FROM customer), g AS (SELECT magnitude, count(*) AS ties FROM d GROUP BY 1)
    SELECT magnitude, ties, sum(ties) OVER (ORDER BY magnitude) - (ties - 1) / 2 AS avg_rank FROM g""",
)
def avg_rank(spark, folder):
    return rel.tie_ranks(tables.table(spark, folder, "customer").select(F.abs("c_acctbal").alias("magnitude")), "magnitude")


FIRST_N = f"""{EV}, r AS (SELECT event_id, cust_id, row_number() OVER (PARTITION BY cust_id ORDER BY event_id) AS user_row FROM ev),
  f AS (SELECT * FROM r WHERE user_row BETWEEN 11 AND 20)"""


@query("user_first_n", f"WITH {FIRST_N} SELECT event_id, cust_id, user_row FROM f")
def user_first_n(spark, folder):
    return rel.user_first_n(
        tables.activity(spark, folder).select("event_id", "cust_id"), "cust_id", [F.col("event_id")], 11, 20
    )


ROW_ORDER = ", ".join(tables.REGRESSION_ORDER)


@query(
    "contiguous_folds",
    f"""WITH {REG}, f AS (SELECT y, ntile(7) OVER (ORDER BY {ROW_ORDER}) AS fold FROM reg)
    SELECT fold, count(*) AS n, round(sum(y), 2) AS total FROM f GROUP BY 1""",
)
def contiguous_folds(spark, folder):
    folds = rel.contiguous_folds(
        tables.regression_rows(spark, folder), [F.col(c) for c in tables.REGRESSION_ORDER], 7
    )
    return folds.groupBy(F.col("fold").cast("long").alias("fold")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("y"), 2).alias("total")
    )


@query("sort_desc", "SELECT o_orderkey, o_orderdate::DATE AS day, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey")
def sort_desc(spark, folder):
    return (
        tables.table(spark, folder, "orders")
        .select("o_orderkey", F.to_date("o_orderdate").alias("day"), "o_totalprice")
        .orderBy(F.desc("o_totalprice"), "o_orderkey")
    )


@query("top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def top_k(spark, folder):
    orders = tables.table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)


@query(
    "sample_take",
    """WITH s AS (SELECT (SELECT count(*) FROM orders) AS rows_total, 6 AS columns_total)
    SELECT o.*, s.rows_total, s.columns_total FROM (SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 5) o, s""",
)
def sample_take(spark, folder):
    orders = tables.table(spark, folder, "orders")
    rows = orders.agg(F.count(F.lit(1))).scalar()
    head = orders.select("o_orderkey", "o_custkey").orderBy("o_orderkey").limit(5)
    return head.withColumn("rows_total", rows).withColumn("columns_total", F.lit(len(orders.columns)))


@query(
    "union_long",
    """WITH p AS (SELECT o_orderkey, o_totalprice / 1000 AS a, c_acctbal AS b FROM orders JOIN customer ON o_custkey = c_custkey)
    SELECT o_orderkey, 'a' AS kind, a AS value FROM p UNION ALL SELECT o_orderkey, 'b', b FROM p""",
)
def union_long(spark, folder):
    return rel.stack(tables.paired(spark, folder), ["a", "b"], ["o_orderkey"])


@query(
    "train_test_union",
    f"""WITH {FIRST_N} SELECT event_id, cust_id, event_id IN (SELECT event_id FROM f) AS in_test FROM ev""",
)
def train_test_union(spark, folder):
    rows = tables.activity(spark, folder).select("event_id", "cust_id")
    test = rel.user_first_n(rows, "cust_id", [F.col("event_id")], 11, 20).select("event_id", "cust_id")
    base = rel.complement(rows, test, ["event_id"])
    return base.withColumn("in_test", F.lit(False)).unionByName(test.withColumn("in_test", F.lit(True)))


@query(
    "random_split",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 10 < 3 THEN 'test' ELSE 'train' END AS part FROM orders",
)
def random_split(spark, folder):
    train, test = rel.modulus_split(tables.table(spark, folder, "orders").select("o_orderkey"), F.col("o_orderkey"), 10, 3)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query("random_split_seeded")
def random_split_seeded(spark, folder):
    train, test = rel.seeded_split(tables.table(spark, folder, "orders").select("o_orderkey"), [0.7, 0.3], seed=1234)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query("business_day_calendar", f"WITH {PANEL} SELECT ticker, date, round(price, 5) AS price FROM panel")
def business_day_calendar(spark, folder):
    panel = timeseries.reindex(tables.series(spark, folder))
    return panel.select("ticker", "date", F.round("price", 5).alias("price"))


@query(
    "histogram",
    """WITH m AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
      b AS (SELECT CAST(least(floor((o_totalprice - lo) * 8 / (hi - lo)), 7) AS INTEGER) AS bin FROM orders, m)
    SELECT CAST(r.bin AS INTEGER) AS bin, round(lo + r.bin * ((hi - lo) / 8), 6) AS bin_start, count(b.bin) AS n
    FROM range(8) r(bin) LEFT JOIN b ON b.bin = r.bin, m GROUP BY r.bin, lo, hi""",
)
def histogram(spark, folder):
    bins = rel.histogram(tables.table(spark, folder, "orders"), "o_totalprice", 8)
    return bins.withColumn("bin_start", F.round("bin_start", 6))
