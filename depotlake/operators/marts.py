"""Pre-aggregated marts and the end-of-day balance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from depotlake.functions.expressions import by_side, cash_flow, month_of, rounded, total, vwap
from depotlake.model import BROKER_KEYS, DAILY_KEYS, PAIR_KEY, POSITION_KEYS


_DEALT = ("_place", "_share")


def _dealt(rows: DataFrame, place: Column, spread: str) -> DataFrame:
    """Rows dealt by the folder their groups are written to, and within it by ``spread``, once.

    Both are told by keys of the mart, so groups stay whole when they are keys as well, and the rows of a folder are in
    few tasks: a mart that has hardly fewer rows than the trades need not be shuffled again to be written.
    """
    reducers = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = F.pmod(F.xxhash64(spread), F.lit(1 + reducers // 16))
    return rows.withColumns(dict(zip(_DEALT, (place, share)))).repartition(*_DEALT)


def daily_security(silver: DataFrame) -> DataFrame:
    """Per day, security and channel.

    Rows are dealt by month and security once, with the columns the mart needs, and stay there: a distinct count would
    otherwise shuffle buffers, hardly fewer than the rows, a second time, and hash them before the first.
    """
    zero = F.lit(0).cast("decimal(20,4)")
    rows = silver.select(*DAILY_KEYS, "amount", "qty", "commission", "side", "investor_id", "price")
    return _dealt(rows, month_of("trade_date"), "security_id").groupBy(*DAILY_KEYS, *_DEALT).agg(
        F.count(F.lit(1)).alias("trade_count"),
        total("amount", "decimal(24,4)").alias("volume"),
        total("qty", "decimal(24,4)").alias("total_qty"),
        total("commission", "decimal(20,4)").alias("total_commission"),
        total(F.coalesce(by_side(F.col("amount"), zero), zero), "decimal(24,4)").alias("buy_volume"),
        total(F.coalesce(by_side(zero, F.col("amount")), zero), "decimal(24,4)").alias("sell_volume"),
        F.count_distinct("investor_id").alias("unique_investors"),
        vwap().alias("vwap"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
    ).drop(*_DEALT)


def positions(silver: DataFrame, bucket: str | None = None) -> DataFrame:
    """Net holding per investor and security; closed positions are not holdings.

    ``bucket``, an expression of the investor, is the folder each is to be written to: rows are then dealt by it.
    """
    keys = POSITION_KEYS
    if bucket is not None:
        rows = silver.select(*POSITION_KEYS, "signed_qty", "side", "net_amount", "trade_ts")
        silver, keys = _dealt(rows, F.expr(bucket), "security_id"), (*POSITION_KEYS, *_DEALT)
    return silver.groupBy(*keys).agg(
        total("signed_qty", "decimal(24,4)").alias("net_qty"),
        total(cash_flow(), "decimal(24,4)").alias("net_cash"),
        F.count(F.lit(1)).alias("trade_count"),
        F.min("trade_ts").alias("first_trade"),
        F.max("trade_ts").alias("last_trade"),
    ).filter(F.col("net_qty") != 0).drop(*_DEALT)


def _first_of(column: str) -> Column:
    """Whether a row is the one that counts for its value within its group; a missing value counts nowhere."""
    place = F.row_number().over(Window.partitionBy(*BROKER_KEYS, *_DEALT, column).orderBy(column))
    return F.col(column).isNotNull() & (place == 1)


def broker_daily(silver: DataFrame) -> DataFrame:
    """Per day, broker and channel. Rows are dealt by month and broker once; two distinct counts in one aggregate would
    shuffle each row twice over, and the groups again."""
    rows = silver.select(*BROKER_KEYS, "amount", "commission", "investor_id", "security_id")
    dealt = _dealt(rows, month_of("trade_date"), "broker_id").withColumn("_investor", _first_of("investor_id")).withColumn(
        "_security", _first_of("security_id"))
    return dealt.groupBy(*BROKER_KEYS, *_DEALT).agg(
        F.count(F.lit(1)).alias("trade_count"),
        total("amount", "decimal(24,4)").alias("volume"),
        total("commission", "decimal(20,4)").alias("total_commission"),
        F.count_if("_investor").alias("unique_investors"),
        F.count_if("_security").alias("unique_securities"),
    ).drop(*_DEALT)


def eod_balance(trades: DataFrame) -> DataFrame:
    """The depository's own balance at the last trade date, straight from trades."""
    signed = by_side(F.col("qty"), -F.col("qty"))
    last_date = trades.agg(F.max("trade_date")).scalar()
    pairs = trades.groupBy(*PAIR_KEY).agg(
        total(signed, "decimal(24,4)").alias("nominal_qty"),
        F.sum("price").alias("price_sum"),
        F.count("price").alias("price_count"),
    ).filter(F.col("nominal_qty") != 0)
    mean_price = F.try_divide(F.col("price_sum").cast("double"), F.col("price_count"))
    worth = rounded(F.col("nominal_qty").cast("double") * mean_price, 4, 20)
    return pairs.select(*PAIR_KEY, last_date.alias("value_date"), "nominal_qty",
                        worth.alias("market_value"))
