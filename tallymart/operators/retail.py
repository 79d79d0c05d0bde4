"""Retail analyses: activity filters, repurchase timing, product affinity, favourites report.

Inputs are activity rows with cust_id, product_id and, for timing, ts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.functions.scalar import DAY_MICROS, half_even, span_micros, whole_days
from tallymart.operators.skew import HOT_ROWS, attach_totals, one_row, salted_join
from tallymart.session import write_through

PAIR = ["cust_id", "product_id"]

# The labels of the reports.
DUE, NOT_DUE = "Recommend", "Do_not_recommend"
CLASSES = ["Class_A", "Class_B", "Class_C", "Class_D", "Class_E"]
# Upper ends of the cumulative-share bands, in percent.
BANDS = [2, 10, 25, 50]


def activity_counts(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(F.count(key).alias("n")).filter(F.col(key).isNotNull())


def count_of_counts(rows: DataFrame, key: str) -> DataFrame:
    """How many keys have n rows."""
    return activity_counts(rows, key).groupBy("n").agg(F.count(F.lit(1)).alias("keys"))


def cumulative_share(histogram: DataFrame, value: str, size: str) -> DataFrame:
    """Running share of the total, from the largest value down.

    Runs over a histogram. Distinct activity counts that sum to N rows number at most sqrt(2N), so
    one task holds it for any table size.
    """
    down = Window.orderBy(F.desc(value)).rowsBetween(Window.unboundedPreceding, 0)
    return histogram.select(
        "*",
        F.sum(size).over(down).cast("long").alias("running"),
        F.sum(size).over(Window.partitionBy()).cast("long").alias("total"),
    )


def heavy_keys(rows: DataFrame, key: str, percent: int = 90) -> DataFrame:
    """Keys whose row count lies above the count at which the cumulative share passes ``percent``.

    The comparison is made in integers. Both activity filters look at the unfiltered rows.
    """
    counts = activity_counts(rows, key)
    histogram = counts.groupBy("n").agg(F.count(F.lit(1)).alias("keys"))
    kept = cumulative_share(histogram, "n", "keys").filter(F.col("running") * 100 <= F.col("total") * percent)
    # cumulative share is monotone in n: the kept counts are exactly those from their minimum upwards
    return counts.filter(F.col("n") >= kept.agg(F.min("n")).scalar())


def training_set(rows: DataFrame, rating: Column | None = None, percent: int = 90) -> DataFrame:
    """Interactions of heavy customers with heavy products, plus a rating column (1 by default)."""
    customers = heavy_keys(rows, "cust_id", percent).select("cust_id")
    products = heavy_keys(rows, "product_id", percent).select("product_id")
    return (
        rows.join(customers, "cust_id", "left_semi")
        .join(products, "product_id", "left_semi")
        .withColumn("rating", F.lit(1) if rating is None else rating)
    )


def negative_feedback(action: str = "action_type") -> Column:
    """Action code 3 counts as -1, every other code as itself."""
    return F.when(F.col(action) == 3, F.lit(-1)).otherwise(F.col(action))


def repeat_purchases(rows: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rows of pairs bought more than once, with the pair's row count."""
    return attach_totals(rows, PAIR, hot_rows, counter=F.count(F.lit(1))).filter(F.col("counter") > 1)


def pair_summary(rows: DataFrame, with_time: bool = True) -> DataFrame:
    """Row count per (customer, product), with first and last timestamp if asked for. Every report
    below is worked out from this table; the rows are touched again only where they are the result."""
    spans = [F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")] if with_time else []
    return rows.groupBy(*PAIR).agg(F.count(F.lit(1)).alias("counter"), *spans)


def _intervals(pairs: DataFrame, floor_span_first: bool) -> DataFrame:
    gaps = F.col("counter") - 1
    if floor_span_first:
        interval = (whole_days("last_ts", "first_ts") - 1) / gaps
    else:
        interval = (span_micros("last_ts", "first_ts") - DAY_MICROS) / (gaps * F.lit(DAY_MICROS))
    return pairs.filter(F.col("counter") > 1).withColumn("repurchase_days", F.floor(interval).cast("long"))


def _averages(intervals: DataFrame, weighting: str) -> DataFrame:
    weight = F.col("counter") if weighting == "row" else F.lit(1)
    return (
        intervals.groupBy("product_id")
        .agg(
            F.sum(F.col("repurchase_days") * weight).alias("interval_total"),
            F.count(F.lit(1)).alias("customers"),
        )
        .withColumn("average_repurchase_time", F.col("interval_total") / F.col("customers"))
    )


def _timing(pairs: DataFrame, floor_span_first: bool, hot_rows: int) -> DataFrame:
    """Repeated pairs with their interval and their product's average."""
    intervals = _intervals(pairs, floor_span_first)
    averages = _averages(intervals, "row").drop("interval_total")
    return salted_join(intervals, averages, ["product_id"], hot_rows=hot_rows, count="customers").drop("customers")


def _judge(as_of: str) -> Column:
    wait = F.coalesce(F.col("repurchase_days").cast("double"), "average_repurchase_time")
    return F.when(_age(as_of) > wait, DUE).otherwise(NOT_DUE)


def _age(as_of: str) -> Column:
    return F.datediff(F.lit(as_of).cast("date"), F.to_date("ts"))


def pair_intervals(rows: DataFrame, floor_span_first: bool = True) -> DataFrame:
    """Per repeated pair: row count and mean days between purchases, less one day, rounded down.

    ``floor_span_first`` is the transaction rule (whole days before dividing); otherwise the exact
    span is divided (event rule).
    """
    return _intervals(pair_summary(rows), floor_span_first)


def repurchase_interval(rows: DataFrame, floor_span_first: bool = True, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The pair's repurchase interval beside each of its purchase rows."""
    pairs = write_through(pair_summary(rows), "pairs")
    table = _intervals(pairs, floor_span_first).select(*PAIR, "counter", "repurchase_days")
    return salted_join(rows, table, PAIR, hot_rows=hot_rows, count="counter")


def average_repurchase_time(rows: DataFrame, floor_span_first: bool = True, weighting: str = "row") -> DataFrame:
    """Per product: interval total over distinct customers.

    ``weighting='row'`` counts a pair once per purchase (the customary report), ``'pair'`` once.
    """
    return _averages(pair_intervals(rows, floor_span_first), weighting)


def _due(
    rows: DataFrame, timing: DataFrame, pairs: DataFrame, as_of: str, hot_rows: int, extra: list[str]
) -> DataFrame:
    table = timing.select(*PAIR, "counter", "repurchase_days", "average_repurchase_time", *extra)
    judged = salted_join(
        rows.select(*PAIR, "ts"), table, PAIR, hot_rows=hot_rows, count="counter", counts=pairs
    )
    return judged.select(
        *PAIR,
        F.to_date("ts").alias("purchase_date"),
        _age(as_of).alias("age_days"),
        "repurchase_days",
        "average_repurchase_time",
        _judge(as_of).alias("recommendation"),
        *extra,
    )


def repurchase_due(
    rows: DataFrame,
    as_of: str,
    floor_span_first: bool = True,
    latest_only: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Label each purchase by whether more days than the interval have passed at ``as_of``.

    A missing timestamp falls back on the product's average. One pair can carry both labels;
    ``latest_only`` judges the pair by its last purchase.
    """
    pairs = write_through(pair_summary(rows), "pairs")
    timing = _timing(pairs, floor_span_first, hot_rows)
    if latest_only:
        rows = pairs.select(*PAIR, F.col("last_ts").alias("ts"))
    return _due(rows, timing, pairs, as_of, hot_rows, [])


def _affinities(pairs: DataFrame, hot_rows: int) -> DataFrame:
    visits = pairs.groupBy("cust_id").agg(
        F.sum("counter").alias("visits"), F.count(F.lit(1)).alias("_pairs")
    )
    several = visits.filter(F.col("visits") > 1)
    joined = salted_join(pairs, several, ["cust_id"], hot_rows=hot_rows, count="_pairs").drop("_pairs")
    share = F.col("counter") / F.col("visits") * 100
    return joined.withColumn("affinity_round", half_even(share).cast("double"))


def affinity(rows: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Share of a customer's rows that fall on each product, in whole percent (half to even);
    customers with a single row are left out."""
    pairs = pair_summary(rows, with_time=False)
    return _affinities(pairs, hot_rows).withColumnRenamed("counter", "combination")


def affinity_distribution(affinities: DataFrame) -> DataFrame:
    """Users per affinity value with the rounded cumulative percentage, largest value first.

    Each customer counts once, with the affinity of its smallest product id. At most 101 values.
    """
    first = affinities.groupBy("cust_id").agg(F.min_by("affinity_round", "product_id").alias("affinity_round"))
    histogram = first.groupBy("affinity_round").agg(F.count(F.lit(1)).alias("users_count"))
    shared = cumulative_share(histogram, "affinity_round", "users_count")
    return shared.select(
        "affinity_round",
        "users_count",
        half_even(F.col("running") * 100 / F.col("total")).cast("double").alias("cum_percent"),
    )


def affinity_cutpoints(distribution: DataFrame) -> DataFrame:
    """One row: smallest affinity of each band, null where a band is empty."""
    share, value = F.col("cum_percent"), F.col("affinity_round")
    edges = [None, *BANDS, None]
    cuts = []
    for name, low, high in zip("abcde", edges[:-1], edges[1:]):
        inside = F.lit(True)
        if low is not None:
            inside = inside & (share > low)
        if high is not None:
            inside = inside & (share <= high)
        cuts.append(F.min(F.when(inside, value)).alias(f"cut_{name}"))
    return distribution.agg(*cuts)


def affinity_class(affinities: DataFrame) -> DataFrame:
    """Class of every pair. Classes B, C and D need the cut point of the class above them as well;
    a pair that no rule takes is in the last class."""
    cuts = one_row(affinity_cutpoints(affinity_distribution(affinities)))
    value = F.col("affinity_round")

    def between(low: str, high: str) -> Column:
        return (value >= F.col("cuts")[low]) & (value < F.col("cuts")[high])

    label = (
        F.when(value >= F.col("cuts")["cut_a"], CLASSES[0])
        .when(between("cut_b", "cut_a"), CLASSES[1])
        .when(between("cut_c", "cut_b"), CLASSES[2])
        .when(between("cut_d", "cut_c"), CLASSES[3])
        .otherwise(CLASSES[4])
    )
    return affinities.withColumn("cuts", cuts).select(
        *PAIR, "affinity_round", label.alias("recommendation_class")
    )


def favourites(
    rows: DataFrame, as_of: str, floor_span_first: bool = True, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Repurchase label and affinity class of every repeat purchase.

    Timing and class are both joined on the pair table, which is written once; the rows are read for
    that table and for the result.
    """
    pairs = write_through(pair_summary(rows), "pairs")
    classes = affinity_class(_affinities(pairs, hot_rows)).select(*PAIR, "recommendation_class")
    timing = _timing(pairs, floor_span_first, hot_rows).join(classes, PAIR)
    return _due(rows, timing, pairs, as_of, hot_rows, ["recommendation_class"])
