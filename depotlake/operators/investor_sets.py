"""Distinct investors that add up: exact bitmaps for each month, security type and channel.

Counts of distinct investors of two days do not add up; sets do. A mart row keeps the set of its investors as bitmaps
of 32,768 numbers each, one row for every such range of investor numbers. Sets of any months are united by OR.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotlake.functions.expressions import month_of
from depotlake.operators.reports import on_dates

SET_KEYS = ("security_type", "channel")


def _sets(trades: DataFrame, *keys: str) -> DataFrame:
    """Investors without a number are in no set; numbers below one count like all others."""
    known = trades.filter(F.col("investor_id").isNotNull())
    return known.groupBy(*keys, F.bitmap_bucket_number("investor_id").alias("range")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("investor_id")).alias("investors"))


def monthly_investors(silver: DataFrame) -> DataFrame:
    """``trade_month, security_type, channel, range, investors``: its size follows months, types, channels and
    investors over 32,768, not trades."""
    return _sets(silver.withColumn("trade_month", month_of("trade_date")), "trade_month", *SET_KEYS)


def whole_months(first: date, last: date) -> tuple[date, date] | None:
    """The first day of the first and the last day of the last month that lie in a closed range as a whole."""
    start = first if first.day == 1 else (first.replace(day=1) + timedelta(days=32)).replace(day=1)
    after = last + timedelta(days=1)
    end = after if after.day == 1 else after.replace(day=1)
    return (start, end - timedelta(days=1)) if start < end else None


def investors_between(sets: DataFrame, silver: DataFrame, first: date, last: date,
                      of: Column | None = None) -> DataFrame:
    """``channel, unique_investors`` of a closed range of days, exactly; ``of`` chooses rows by ``SET_KEYS``.

    Whole months come from the sets; only the days of the months at both ends are read from ``silver``.
    """
    chosen = F.lit(True) if of is None else of
    months = whole_months(first, last)
    if months is None:
        parts = [_sets(on_dates(silver.filter(chosen), first, last), "channel")]
    else:
        within = F.col("trade_month").between(*(day.strftime("%Y-%m") for day in months))
        parts = [sets.filter(within & chosen).select("channel", "range", "investors")]
        edges = [(first, months[0] - timedelta(days=1)), (months[1] + timedelta(days=1), last)]
        parts += [_sets(on_dates(silver.filter(chosen), *edge), "channel") for edge in edges if edge[0] <= edge[1]]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    united = every.groupBy("channel", "range").agg(F.bitmap_or_agg("investors").alias("investors"))
    return united.groupBy("channel").agg(F.sum(F.bitmap_count("investors")).alias("unique_investors"))
