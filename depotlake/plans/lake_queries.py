"""Scans, typed bronze, silver and its quality rules."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depotlake.model import TRADE
from depotlake.operators import quality, silver
from depotlake.operators.dedup import latest_per_key
from depotlake.plans.registry import FAULTY, LATEST, SILVER, TRADES, query, sql
from depotlake.sources import tables
from depotlake.sources.ingest import changed_since, key_bounds, typed


def silver_trades(spark: SparkSession, folder: str) -> DataFrame:
    """Latest version of every trade with its attributes."""
    return silver.enrich(latest_per_key(tables.trades(spark, folder)),
                         tables.investors(spark, folder), tables.securities(spark, folder))


def resolved_trades(spark: SparkSession, folder: str) -> DataFrame:
    """The careless feed with an outcome for every trade."""
    return silver.resolve(tables.faulty_trades(spark, folder), tables.investors(spark, folder),
                          tables.listed_securities(spark, folder))


@query("scan_trades", sql(TRADES, "select * from t"))
def scan_trades(spark, folder):
    return tables.trades(spark, folder)


@query("bronze_typed", sql(TRADES, "select * from t"))
def bronze_typed(spark, folder):
    """Every column comes as text and leaves in its declared type."""
    trades = tables.trades(spark, folder)
    return typed(trades.select(*(F.col(name).cast("string").alias(name) for name in trades.columns)), TRADE)


@query("key_bounds", sql(TRADES, """
    select min(trade_id) as lo, max(trade_id) as hi, count(*) as n,
           min(trade_date) as first_date, max(trade_date) as last_date from t"""))
def bounds(spark, folder):
    return key_bounds(tables.trades(spark, folder), "trade_id", "trade_date")


@query("incremental_since", sql(TRADES, """
    select * from t where updated_ts >= timestamp '2000-01-01 00:00:00'"""))
def incremental_since(spark, folder):
    return changed_since(tables.trades(spark, folder), datetime(2000, 1, 1))


@query("dedup_latest", sql(LATEST, "select * from d"))
def dedup_latest(spark, folder):
    return latest_per_key(tables.trades(spark, folder))


@query("enriched_trades", sql(SILVER, "select * from e"))
def enriched_trades(spark, folder):
    return silver_trades(spark, folder)


@query("silver_valid", sql(FAULTY, "select * exclude (reason) from outcome where reason = ''"))
def silver_valid(spark, folder):
    return silver.valid_only(resolved_trades(spark, folder))


@query("quarantine_reasons", sql(FAULTY, """
    select trade_id, investor_id, security_id, trade_ts, amount, qty, side, reason
    from outcome where reason <> ''"""))
def quarantine_reasons(spark, folder):
    return silver.quarantined_only(resolved_trades(spark, folder))


_DQ = """
    select 'table is empty' as rule, case when count(*) = 0 then 1 else 0 end::bigint as violations from f
    union all select 'trade_id repeated', count(*) from
        (select trade_id from f group by trade_id having count(*) > 1)
    union all select 'trade_id is null', count(*) filter (trade_id is null) from f
    union all select 'investor_id is null', count(*) filter (investor_id is null) from f
    union all select 'security_id is null', count(*) filter (security_id is null) from f
    union all select 'trade_ts is null', count(*) filter (trade_ts is null) from f
    union all select 'side is null', count(*) filter (side is null) from f
    union all select 'qty is null', count(*) filter (qty is null) from f
    union all select 'price is null', count(*) filter (price is null) from f
    union all select 'amount is null', count(*) filter (amount is null) from f
    union all select 'updated_ts is null', count(*) filter (updated_ts is null) from f
    union all select 'amount differs from qty * price',
        count(*) filter (abs(amount - qty * price) > 0.01) from f
    union all select 'amount not positive', count(*) filter (amount <= 0) from f
    union all select 'qty not positive', count(*) filter (qty <= 0) from f
    union all select 'side unknown', count(*) filter (side not in ('BUY', 'SELL')) from f"""


@query("dq_report", sql("raw f", _DQ))
def dq_report(spark, folder):
    return quality.quality_report(tables.faulty_trades(spark, folder))


@query("dq_null_counts", sql("raw f", """
    select count(*) filter (investor_id is null) as investor_id,
           count(*) filter (security_id is null) as security_id,
           count(*) filter (trade_ts is null) as trade_ts,
           count(*) filter (side is null) as side,
           count(*) filter (amount is null) as amount from f"""))
def dq_null_counts(spark, folder):
    names = ("investor_id", "security_id", "trade_ts", "side", "amount")
    return tables.faulty_trades(spark, folder).agg(
        *(F.count_if(F.col(n).isNull()).alias(n) for n in names))


@query("dq_duplicate_keys", sql(TRADES, """
    select count(*) as repeated_keys from
        (select trade_id from t group by trade_id having count(*) > 1)"""))
def dq_duplicate_keys(spark, folder):
    repeated = quality.duplicate_keys(tables.trades(spark, folder))
    return repeated.agg(F.count(F.lit(1)).alias("repeated_keys"))
