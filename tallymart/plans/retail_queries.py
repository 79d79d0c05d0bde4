"""Retail analyses over the transaction log and, as ``_events`` variants, the event log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.operators import relational as rel
from tallymart.operators import retail
from tallymart.plans.registry import EV, TX, query
from tallymart.plans.relational_queries import HEAVY
from tallymart.sources import tables

# Report dates: both labels occur at every scale.
TX_AS_OF, EV_AS_OF = "2001-12-31", "2024-01-31"


def _tx(spark: SparkSession, folder: str) -> DataFrame:
    return tables.transactions(spark, folder).drop("revenue")


def _ev(spark: SparkSession, folder: str) -> DataFrame:
    return tables.activity(spark, folder)


# variant -> (rows, SQL view, name of the view, suffix, whole days first, report date)
VARIANTS = [
    (_tx, TX, "tx", "", True, TX_AS_OF),
    (_ev, EV, "ev", "_events", False, EV_AS_OF),
]


def _interval_sql(view: str, floor_first: bool) -> str:
    span = "(epoch_us(max(ts)) - epoch_us(min(ts)))"
    if floor_first:
        days = f"floor((floor({span} / 86400000000.0) - 1) / (count(*) - 1))"
    else:
        days = f"floor(({span} - 86400000000) / ((count(*) - 1) * 86400000000.0))"
    return f"""iv AS (SELECT cust_id, product_id, count(*) AS counter, CAST({days} AS BIGINT) AS repurchase_days
    FROM {view} GROUP BY 1, 2 HAVING count(*) > 1)"""


AVERAGE = """av AS (SELECT product_id, CAST(sum(repurchase_days * counter) AS BIGINT) AS interval_total, count(*) AS customers,
    sum(repurchase_days * counter) / count(*) AS average_repurchase_time FROM iv GROUP BY 1)"""


def _due_sql(view: str, as_of: str) -> str:
    return f"""due AS (SELECT cust_id, product_id, CAST(ts AS DATE) AS purchase_date,
      CAST(date_diff('day', CAST(ts AS DATE), DATE '{as_of}') AS INTEGER) AS age_days, repurchase_days,
      average_repurchase_time, CASE WHEN date_diff('day', CAST(ts AS DATE), DATE '{as_of}') > repurchase_days
        THEN 'Recommend' ELSE 'Do_not_recommend' END AS recommendation
    FROM {view} JOIN iv USING (cust_id, product_id) JOIN av USING (product_id))"""


def _affinity_sql(view: str) -> str:
    return f"""af AS (SELECT cust_id, product_id, count(*) AS combination, v.visits,
      CAST(round_even(count(*) / v.visits * 100, 0) AS DOUBLE) AS affinity_round
    FROM {view} JOIN (SELECT cust_id, count(*) AS visits FROM {view} GROUP BY 1 HAVING count(*) > 1) v USING (cust_id)
    GROUP BY cust_id, product_id, v.visits)"""


DISTRIBUTION = """fp AS (SELECT *, row_number() OVER (PARTITION BY cust_id ORDER BY product_id) AS rn FROM af),
  di AS (SELECT affinity_round, count(*) AS users_count,
    CAST(round_even(sum(count(*)) OVER (ORDER BY affinity_round DESC) * 100 / sum(count(*)) OVER (), 0) AS DOUBLE) AS cum_percent
    FROM fp WHERE rn = 1 GROUP BY 1)"""

CUTS = """cu AS (SELECT min(affinity_round) FILTER (cum_percent <= 2) AS cut_a,
    min(affinity_round) FILTER (cum_percent > 2 AND cum_percent <= 10) AS cut_b,
    min(affinity_round) FILTER (cum_percent > 10 AND cum_percent <= 25) AS cut_c,
    min(affinity_round) FILTER (cum_percent > 25 AND cum_percent <= 50) AS cut_d,
    min(affinity_round) FILTER (cum_percent > 50) AS cut_e FROM di)"""

CLASSES = """cl AS (SELECT cust_id, product_id, affinity_round,
    CASE WHEN affinity_round >= cut_a THEN 'Class_A'
      WHEN affinity_round >= cut_b AND affinity_round < cut_a THEN 'Class_B'
      WHEN affinity_round >= cut_c AND affinity_round < cut_b THEN 'Class_C'
      WHEN affinity_round >= cut_d AND affinity_round < cut_c THEN 'Class_D'
      ELSE 'Class_E' END AS recommendation_class FROM af, cu)"""


def _register(rows, cte: str, view: str, suffix: str, floor_first: bool, as_of: str) -> None:
    interval = _interval_sql(view, floor_first)
    due = _due_sql(view, as_of)
    affinity = _affinity_sql(view)
    heavy = HEAVY.format(t=view)

    query(f"heavy_customers{suffix}", f"WITH {cte}, {heavy} SELECT cust_id, n FROM hc")(
        lambda s, f: retail.heavy_keys(rows(s, f), "cust_id")
    )
    query(f"heavy_products{suffix}", f"WITH {cte}, {heavy} SELECT product_id, n FROM hp")(
        lambda s, f: retail.heavy_keys(rows(s, f), "product_id")
    )
    query(
        f"repeat_purchases{suffix}",
        f"""WITH {cte}, c AS (SELECT cust_id, product_id, count(*) AS counter FROM {view} GROUP BY 1, 2)
        SELECT cust_id, product_id, CAST(ts AS DATE) AS day, counter FROM {view} JOIN c USING (cust_id, product_id) WHERE counter > 1""",
    )(
        lambda s, f: retail.repeat_purchases(rows(s, f)).select(
            "cust_id", "product_id", F.to_date("ts").alias("day"), "counter"
        )
    )
    query(
        f"repurchase_interval{suffix}",
        f"""WITH {cte}, {interval} SELECT cust_id, product_id, CAST(ts AS DATE) AS day, counter, repurchase_days
        FROM {view} JOIN iv USING (cust_id, product_id)""",
    )(
        lambda s, f: retail.repurchase_interval(rows(s, f), floor_first).select(
            "cust_id", "product_id", F.to_date("ts").alias("day"), "counter", "repurchase_days"
        )
    )
    query(f"avg_repurchase_time{suffix}", f"WITH {cte}, {interval}, {AVERAGE} SELECT * FROM av")(
        lambda s, f: retail.average_repurchase_time(rows(s, f), floor_first)
    )
    query(f"repurchase_due{suffix}", f"WITH {cte}, {interval}, {AVERAGE}, {due} SELECT * FROM due")(
        lambda s, f: retail.repurchase_due(rows(s, f), as_of, floor_first)
    )
    query(f"affinity{suffix}", f"WITH {cte}, {affinity} SELECT * FROM af")(lambda s, f: retail.affinity(rows(s, f)))
    query(f"affinity_distribution{suffix}", f"WITH {cte}, {affinity}, {DISTRIBUTION} SELECT * FROM di")(
        lambda s, f: retail.affinity_distribution(retail.affinity(rows(s, f)))
    )
    query(f"affinity_cutpoints{suffix}", f"WITH {cte}, {affinity}, {DISTRIBUTION}, {CUTS} SELECT * FROM cu")(
        lambda s, f: retail.affinity_cutpoints(retail.affinity_distribution(retail.affinity(rows(s, f))))
    )
    query(f"affinity_class{suffix}", f"WITH {cte}, {affinity}, {DISTRIBUTION}, {CUTS}, {CLASSES} SELECT * FROM cl")(
        lambda s, f: retail.affinity_class(retail.affinity(rows(s, f)))
    )
    query(
        f"favourites{suffix}",
        f"""WITH {cte}, {interval}, {AVERAGE}, {due}, {affinity}, {DISTRIBUTION}, {CUTS}, {CLASSES}
        SELECT due.*, recommendation_class FROM due JOIN cl USING (cust_id, product_id)""",
    )(lambda s, f: retail.favourites(rows(s, f), as_of, floor_first))


for variant in VARIANTS:
    _register(*variant)


@query(
    "als_training_set",
    f"""WITH {TX}, {HEAVY.format(t="tx")} SELECT cust_id, product_id, 1 AS rating FROM tx
    WHERE cust_id IN (SELECT cust_id FROM hc) AND product_id IN (SELECT product_id FROM hp)""",
)
def als_training_set(spark, folder):
    return retail.training_set(_tx(spark, folder)).select("cust_id", "product_id", "rating")


@query(
    "als_training_set_events",
    f"""WITH {EV}, {HEAVY.format(t="ev")} SELECT cust_id, product_id, CASE WHEN action_type = 3 THEN -1 ELSE action_type END AS rating
    FROM ev WHERE cust_id IN (SELECT cust_id FROM hc) AND product_id IN (SELECT product_id FROM hp)""",
)
def als_training_set_events(spark, folder):
    rows = _ev(spark, folder)
    return retail.training_set(rows, retail.negative_feedback()).select("cust_id", "product_id", "rating")


@query(
    "repurchase_due_latest",
    f"""WITH {TX}, {_interval_sql("tx", True)}, {AVERAGE}, m AS (SELECT cust_id, product_id, max(ts) AS ts FROM tx GROUP BY 1, 2),
    {_due_sql("m", TX_AS_OF)} SELECT * FROM due""",
)
def repurchase_due_latest(spark, folder):
    return retail.repurchase_due(_tx(spark, folder), TX_AS_OF, latest_only=True)


@query(
    "avg_repurchase_time_by_pair",
    f"""WITH {TX}, {_interval_sql("tx", True)} SELECT product_id, CAST(sum(repurchase_days) AS BIGINT) AS interval_total,
      count(*) AS customers, sum(repurchase_days) / count(*) AS average_repurchase_time FROM iv GROUP BY 1""",
)
def avg_repurchase_time_by_pair(spark, folder):
    return retail.average_repurchase_time(_tx(spark, folder), weighting="pair")
