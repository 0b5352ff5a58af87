"""Marts and the end-of-day balance over the whole trade table."""

from __future__ import annotations

from depotlake.operators import marts
from depotlake.operators.dedup import latest_per_key
from depotlake.plans.lake_queries import silver_trades
from depotlake.plans.registry import SILVER, TRADES, query, sql
from depotlake.sources import tables


@query("gold_daily_security", sql(SILVER + " daily", "select * from daily"))
def gold_daily_security(spark, folder):
    return marts.daily_security(silver_trades(spark, folder))


@query("gold_positions", sql(SILVER + " pos", "select * from pos"))
def gold_positions(spark, folder):
    return marts.positions(silver_trades(spark, folder))


@query("gold_broker_daily", sql(SILVER + " broker", "select * from broker"))
def gold_broker_daily(spark, folder):
    """Needs no attribute of a dimension, so none is joined."""
    return marts.broker_daily(latest_per_key(tables.trades(spark, folder)))


@query("eod_balance", sql(TRADES, """
    select investor_id, security_id, (select max(trade_date) from t) as value_date,
           cast(sum(case when side = 'BUY' then qty else -qty end) as decimal(24,4)) as nominal_qty,
           cast(cast(cast(sum(case when side = 'BUY' then qty else -qty end) as double)
                     * (cast(sum(price) as double) / count(price)) as decimal(23,7))
                as decimal(20,4)) as market_value
    from t group by investor_id, security_id
    having sum(case when side = 'BUY' then qty else -qty end) <> 0"""))
def eod_balance(spark, folder):
    return marts.eod_balance(tables.trades(spark, folder))
