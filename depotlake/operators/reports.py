"""Reporting queries over trades and marts."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotlake.functions.expressions import at, month_start, rounded, total
from depotlake.operators.joins import join_dimension


def date_between(first: date, last: date, column: str = "trade_date") -> Column:
    return F.col(column).between(F.lit(first), F.lit(last))


def in_months(rows: DataFrame, first: date, last: date) -> DataFrame:
    """Only the folders of the months from ``first`` to ``last``, where there are such
    folders: a reader prunes directories on the partition column itself only."""
    if "trade_month" not in rows.columns:
        return rows
    return rows.filter(F.col("trade_month").between(first.strftime("%Y-%m"), last.strftime("%Y-%m")))


def on_dates(rows: DataFrame, first: date, last: date) -> DataFrame:
    """Rows whose trade date is in a closed range."""
    return in_months(rows.filter(date_between(first, last)), first, last)


def trades_between(trades: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Trades of a half-open time range.

    Where the table is partitioned by month, exactly the months of the range are
    read: a range that ends at midnight of a first day does not reach into its month.
    """
    stamp = F.col("trade_ts")
    kept = trades.filter((stamp >= at(start)) & (stamp < at(end)))
    return in_months(kept, start, end - timedelta(microseconds=1))


def midnight(day: date) -> datetime:
    return datetime.combine(day, time())


def by_channel(trades: DataFrame) -> DataFrame:
    return trades.groupBy("channel").agg(
        F.count(F.lit(1)).alias("trade_count"),
        total("amount", "decimal(24,4)").alias("volume"),
        F.count_distinct("investor_id").alias("unique_investors"),
    )


def channel_report(trades: DataFrame, security_type: str, first: date, last: date) -> DataFrame:
    """One security type over a date range, per channel, on detail rows."""
    rows = on_dates(trades.filter(F.col("security_type") == security_type), first, last)
    return by_channel(rows).orderBy(F.desc("volume"), "channel")


def channel_report_on_source(trades: DataFrame, securities: DataFrame, security_type: str,
                             first: date, last: date) -> DataFrame:
    """The same report on the operational tables: the security filter goes into
    the dimension and the date filter into the trade scan."""
    typed = securities.filter(F.col("security_type") == security_type).select("security_id")
    rows = on_dates(trades, first, last)
    joined = join_dimension(rows, typed, "security_id", how="inner")
    return by_channel(joined).orderBy(F.desc("volume"), "channel")


def channel_report_on_mart(daily: DataFrame, security_type: str, first: date,
                           last: date) -> DataFrame:
    """The report from the daily mart. Distinct investors are left out: distinct
    counts of days do not add up to the distinct count of the range."""
    rows = on_dates(daily.filter(F.col("security_type") == security_type), first, last)
    return rows.groupBy("channel").agg(
        F.sum("trade_count").alias("trade_count"),
        total("volume", "decimal(24,4)").alias("volume"),
    ).orderBy(F.desc("volume"), "channel")


def top_securities(trades: DataFrame, securities: DataFrame, k: int = 10) -> DataFrame:
    """The k securities of the greatest volume. Names join after the limit."""
    top = trades.groupBy("security_id").agg(
        F.count(F.lit(1)).alias("trade_count"),
        total("amount", "decimal(24,4)").alias("volume"),
        F.count_distinct("investor_id").alias("unique_investors"),
    ).orderBy(F.desc("volume"), "security_id").limit(k)
    named = securities.select("security_id", "short_code", "security_type")
    return named.join(F.broadcast(top), "security_id").orderBy(F.desc("volume"), "security_id")


def top_on_mart(daily: DataFrame, first: date, last: date, k: int = 10) -> DataFrame:
    return on_dates(daily, first, last).groupBy("security_id", "short_code").agg(
        total("volume", "decimal(24,4)").alias("volume"),
        F.sum("trade_count").alias("trade_count"),
    ).orderBy(F.desc("volume"), "security_id").limit(k)


def monthly_channel_trend(trades: DataFrame) -> DataFrame:
    return trades.groupBy(month_start("trade_date").alias("month"), "channel").agg(
        F.count(F.lit(1)).alias("trade_count"),
        rounded(F.sum("amount").cast("double") / 1e6, 2).alias("volume_millions"),
    ).orderBy("month", "channel")


def channel_summary(trades: DataFrame) -> DataFrame:
    return trades.groupBy("channel").agg(
        F.count(F.lit(1)).alias("trade_count"),
        rounded(F.sum("amount").cast("double") / 1e9, 2).alias("volume_billions"),
        F.count_distinct("investor_id").alias("unique_investors"),
    ).orderBy(F.desc("volume_billions"), "channel")


def totals(trades: DataFrame) -> DataFrame:
    mean = F.try_divide(F.sum("amount").cast("double"), F.count("amount"))
    return trades.agg(
        F.count(F.lit(1)).alias("trade_count"),
        total("amount", "decimal(24,4)").alias("volume"),
        rounded(mean, 4).alias("mean_amount"),
    )


def closed_account_volume(trades: DataFrame, investors: DataFrame) -> DataFrame:
    """Trades booked on inactive accounts, by investor type."""
    closed = investors.filter(~F.col("active")).select("investor_id", "investor_type")
    return join_dimension(trades, closed, "investor_id", how="inner").groupBy("investor_type").agg(
        F.count(F.lit(1)).alias("trade_count"),
        total("amount", "decimal(24,4)").alias("volume"),
    ).orderBy(F.desc("volume"), "investor_type")


def speedup(costs: DataFrame, label: str, cost: str) -> DataFrame:
    """Every row's factor against the most expensive one. The maximum is a
    scalar subquery, so no row has to move for it."""
    worst = costs.agg(F.max(cost)).scalar()
    factor = worst.cast("double") / F.greatest(F.col(cost), F.lit(1)).cast("double")
    return costs.select(label, cost, rounded(factor, 4).alias("factor"))
