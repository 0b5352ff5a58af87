"""Column expressions shared by the jobs; every one stays in the JVM."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotlake.model import BUY, SELL
from depotlake.session import MIB


def holds(predicate: Column) -> Column:
    """True only when the predicate is true; NULL counts as not fulfilled.

    A filter and its negation then split a table without losing rows.
    """
    return F.coalesce(predicate, F.lit(False))


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (names ignore case)."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def at(moment: datetime) -> Column:
    """A literal without time zone: neither the driver's zone nor the session's
    shifts it."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def by_side(buy: Column, sell: Column) -> Column:
    """Pick by trade side; an unknown side gives NULL instead of a sale."""
    side = F.col("side")
    return F.when(side == BUY, buy).when(side == SELL, sell)


def signed_qty() -> Column:
    return by_side(F.col("qty"), -F.col("qty"))


def net_amount() -> Column:
    """Amount less commission, for both sides."""
    return (F.col("amount") - F.col("commission")).cast("decimal(20,4)")


def cash_flow() -> Column:
    """Net amount as money received: negative for buys. A buy is thus booked
    at amount less commission, as the position report defines it."""
    return by_side(-F.col("net_amount"), F.col("net_amount"))


def amount_gap() -> Column:
    return F.abs(F.col("amount") - F.col("qty") * F.col("price"))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division that yields NULL for a zero divisor under ANSI rules."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def rounded(value: Column, digits: int, precision: int = 24) -> Column:
    """A double as a decimal of ``digits`` places, halves away from zero.

    The first cast takes away the noise in the last bits, so that a half is seen
    as a half whichever engine divided.
    """
    return (value.cast(f"decimal({precision + 3},{digits + 3})")
            .cast(f"decimal({precision},{digits})"))


def vwap() -> Column:
    """Volume-weighted average price, an aggregate expression."""
    weighted = F.sum(F.col("price") * F.col("qty"))
    return rounded(ratio(weighted, F.sum("qty")), 6)


def total(column: Column | str, scale_type: str) -> Column:
    return F.sum(column).cast(scale_type)


# Partition transforms: derived columns that a reader can prune on. Layouts name them as text, as manifests keep it.

def by_month(stamp: str) -> str:
    return f"date_format({stamp}, 'yyyy-MM')"


def by_day(stamp: str) -> str:
    return f"to_date({stamp})"


def by_year(stamp: str) -> str:
    return f"year({stamp})"


def by_bucket(key: str, buckets: int) -> str:
    return f"pmod(hash({key}), {buckets})"


def month_of(stamp: str) -> Column:
    return F.expr(by_month(stamp))


def month_start(stamp: Column | str) -> Column:
    return F.trunc(stamp, "MM")


def mebibytes(size: Column) -> Column:
    return F.round(size / F.lit(float(MIB)), 2)


def human_size(size: Column) -> Column:
    """Bytes as text with a binary unit."""
    steps = ((1 << 40, "TiB"), (1 << 30, "GiB"), (1 << 20, "MiB"), (1 << 10, "KiB"))
    text = F.concat(F.format_number(size.cast("double"), 2), F.lit(" B"))
    for step, unit in reversed(steps):
        scaled = F.concat(F.format_number(size / F.lit(float(step)), 2), F.lit(f" {unit}"))
        text = F.when(size >= step, scaled).otherwise(text)
    return text


def human_count(number: Column) -> Column:
    """A row count as text with a decimal unit."""
    steps = ((10**9, "billion"), (10**6, "million"), (10**3, "thousand"))
    text = F.format_number(number.cast("double"), 2)
    for step, unit in reversed(steps):
        scaled = F.concat(F.format_number(number / F.lit(float(step)), 2), F.lit(f" {unit}"))
        text = F.when(number >= step, scaled).otherwise(text)
    return text
