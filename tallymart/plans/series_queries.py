"""Price panels, moving averages and the date-aligned macro table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymart.operators import timeseries
from tallymart.plans.registry import query
from tallymart.plans.relational_queries import MACRO_SQL, PANEL
from tallymart.sources import tables

FILLED = f"""{PANEL}, filled AS (SELECT ticker, date, last_value(price IGNORE NULLS) OVER
  (PARTITION BY ticker ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS price FROM panel)"""


def _panel(spark, folder):
    return timeseries.price_panel(tables.series(spark, folder))


@query("price_panel", f"WITH {FILLED} SELECT ticker, date, round(price, 5) AS price FROM filled")
def price_panel(spark, folder):
    return _panel(spark, folder).select("ticker", "date", F.round("price", 5).alias("price"))


@query(
    "moving_averages",
    f"""WITH {FILLED} SELECT ticker, date, round(price, 5) AS price,
      CASE WHEN count(price) OVER s = 20 THEN round(avg(price) OVER s, 6) END AS short_mean,
      CASE WHEN count(price) OVER l = 100 THEN round(avg(price) OVER l, 6) END AS long_mean
    FROM filled WINDOW s AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW),
      l AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)""",
)
def moving_averages(spark, folder):
    return timeseries.moving_averages(_panel(spark, folder)).select(
        "ticker",
        "date",
        F.round("price", 5).alias("price"),
        F.round("short_mean", 6).alias("short_mean"),
        F.round("long_mean", 6).alias("long_mean"),
    )


@query("macro_join", MACRO_SQL)
def macro_join(spark, folder):
    return timeseries.align_on_date(tables.macro_tables(spark, folder)).select(
        "date",
        F.round("mean_order_price", 5).alias("mean_order_price"),
        "order_count",
        F.round("mean_discount", 9).alias("mean_discount"),
        F.round("mean_quantity", 9).alias("mean_quantity"),
        F.round("quarter_spend", 2).alias("quarter_spend"),
    )
