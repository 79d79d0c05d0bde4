"""Daily price series. A ticker has one row per calendar day, so a per-ticker window is bounded by
the length of the calendar, whatever the size of the source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def business_days(tickers: DataFrame, start: Column, end: Column) -> DataFrame:
    """Every Monday-to-Friday date of the range for each row of ``tickers``."""
    days = F.sequence(start.cast("date"), end.cast("date"))
    return tickers.select("*", F.explode(days).alias("date")).filter(F.weekday("date") < 5)


def reindex(prices: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Prices on the business-day calendar: weekend rows go, missing days become null. Without ``start`` or ``end`` the
    calendar begins or ends with the prices."""
    first = prices.agg(F.min("date")).scalar() if start is None else F.lit(start)
    last = prices.agg(F.max("date")).scalar() if end is None else F.lit(end)
    calendar = business_days(prices.select("ticker").distinct(), first, last)
    return calendar.join(prices, ["ticker", "date"], "left")


def forward_fill(prices: DataFrame, column: str = "price") -> DataFrame:
    """Last known value per ticker; leading gaps stay null."""
    past = Window.partitionBy("ticker").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return prices.withColumn(column, F.last(column, ignorenulls=True).over(past))


def price_panel(prices: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    return forward_fill(reindex(prices, start, end))


def rolling_mean(prices: DataFrame, days: int, name: str, column: str = "price") -> DataFrame:
    """Mean of the last ``days`` rows, null until that many values are there."""
    frame = Window.partitionBy("ticker").orderBy("date").rowsBetween(-(days - 1), 0)
    full = F.count(column).over(frame) == days
    return prices.withColumn(name, F.when(full, F.avg(column).over(frame)))


def moving_averages(prices: DataFrame, short: int = 20, long: int = 100) -> DataFrame:
    return rolling_mean(rolling_mean(prices, short, "short_mean"), long, "long_mean")


def align_on_date(tables: list[DataFrame]) -> DataFrame:
    """Inner join of series on their date: only shared dates survive."""
    first, *others = tables
    for other in others:
        first = first.join(other, "date")
    return first
