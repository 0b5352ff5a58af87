"""Business-day calendar derived from the traded date range."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def business_calendar(trades: DataFrame) -> DataFrame:
    """Weekdays between the first and last trade date, numbered from zero.

    Only the two boundary dates are aggregated from the trades; the window then
    runs over one row per day of that range, so its size is bounded by time.
    """
    span = trades.agg(F.min("trade_date").alias("lo"), F.max("trade_date").alias("hi"))
    days = span.select(F.explode(F.expr("sequence(lo, hi, interval 1 day)")).alias("day"))
    weekdays = days.filter(F.weekday("day") < 5)
    number = F.row_number().over(Window.partitionBy().orderBy("day")) - 1
    return weekdays.select(number.cast("int").alias("idx"), "day")


def business_day_volume(trades: DataFrame) -> DataFrame:
    """Trades per numbered business day; trades are summed per day first, so the
    join sees one row per day instead of one per trade."""
    per_day = trades.groupBy("trade_date").agg(
        F.count(F.lit(1)).alias("trade_count"),
        F.sum("amount").cast("decimal(24,4)").alias("volume"),
    )
    calendar = business_calendar(trades)
    return calendar.join(per_day, calendar.day == per_day.trade_date).select(
        "idx", "day", "trade_count", "volume")
