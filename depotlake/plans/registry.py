"""Named queries over the given tables, each with SQL that states its result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without ``sql`` only its rows can be checked."""
    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function
    return register


_LINES = """
    select l_orderkey * 10 + l_linenumber as trade_id,
           o_custkey as investor_id, l_partkey as security_id, l_suppkey as broker_id,
           l_shipdate as trade_ts, cast(l_shipdate as date) as trade_date,
           case when l_linestatus = 'O' then 'BUY' else 'SELL' end as side,
           cast(l_quantity as decimal(18,4)) as qty,
           cast(cast(l_extendedprice / l_quantity as decimal(18,8)) as decimal(18,6)) as price,
           cast(l_extendedprice as decimal(20,4)) as amount,
           cast(l_extendedprice * l_discount as decimal(12,4)) as commission,
           o_orderpriority as channel, l_shipdate as updated_ts,
           cast(l_tax as decimal(4,2)) as tax, cast(l_discount as decimal(4,2)) as discount
    from lineitem join orders on l_orderkey = o_orderkey"""

_LATEST = """
    select * exclude (rn) from (
        select *, row_number() over (partition by trade_id
            order by updated_ts desc, security_id desc, broker_id desc) as rn from {source})
    where rn = 1"""

_ENRICHED = """
    select {source}.*, hour(trade_ts)::int as trade_hour,
           case side when 'BUY' then qty when 'SELL' then cast(-qty as decimal(18,4)) end as signed_qty,
           cast(amount - commission as decimal(20,4)) as net_amount,
           investor_type, country, short_code, security_type, market
    from {source} left join c on {source}.investor_id = c.investor_id
                  left join {dimension} on {source}.security_id = {dimension}.security_id"""

# Building blocks of the SQL texts, in the order in which they depend on each other.
_BLOCKS = {
    "raw": _LINES,
    "t": "select * exclude (tax, discount) from raw",
    "f": """
    select * exclude (tax, discount) replace (
        case when discount = 0.10 and tax = 0.08 then null else amount end as amount,
        case when discount = 0.10 and tax = 0.07 then cast(-qty as decimal(18,4)) else qty end as qty,
        case when discount = 0.10 and tax = 0.06 then null
             when discount = 0.10 and tax = 0.05 then 'X' else side end as side)
    from raw""",
    "d": _LATEST.format(source="t"),
    "df": _LATEST.format(source="f"),
    "c": """
    select c_custkey as investor_id, c_mktsegment as investor_type, n_name as country,
           c_acctbal >= 0 as active
    from customer join nation on c_nationkey = n_nationkey""",
    "s": """
    select p_partkey as security_id, p_name as short_code, p_type as security_type,
           p_brand as market from part""",
    "listed": """
    select p_partkey as security_id, p_name as short_code, p_type as security_type,
           p_brand as market from part where p_size <= 45""",
    "e": _ENRICHED.format(source="d", dimension="s"),
    "ef": _ENRICHED.format(source="df", dimension="listed"),
    "outcome": """
    select *, concat_ws('; ',
        case when investor_type is null then 'no matching investor' end,
        case when security_type is null then 'no matching security' end,
        case when amount is null then 'amount missing' end,
        case when amount <= 0 then 'amount not positive' end,
        case when qty is null then 'quantity missing' end,
        case when qty <= 0 then 'quantity not positive' end,
        case when side is null then 'side missing' end,
        case when side not in ('BUY', 'SELL') then 'side unknown' end) as reason
    from ef""",
    "daily": """
    select trade_date, security_id, short_code, security_type, market, channel,
           count(*) as trade_count,
           cast(sum(amount) as decimal(24,4)) as volume,
           cast(sum(qty) as decimal(24,4)) as total_qty,
           cast(sum(commission) as decimal(20,4)) as total_commission,
           cast(sum(case when side = 'BUY' then amount else 0 end) as decimal(24,4)) as buy_volume,
           cast(sum(case when side = 'SELL' then amount else 0 end) as decimal(24,4)) as sell_volume,
           count(distinct investor_id) as unique_investors,
           cast(cast(cast(sum(price * qty) as double) / cast(sum(qty) as double)
                     as decimal(27,9)) as decimal(24,6)) as vwap,
           min(price) as min_price, max(price) as max_price
    from e group by all""",
    "pos": """
    select investor_id, investor_type, country, security_id, short_code, security_type,
           cast(sum(signed_qty) as decimal(24,4)) as net_qty,
           cast(sum(case side when 'BUY' then -net_amount else net_amount end)
                as decimal(24,4)) as net_cash,
           count(*) as trade_count, min(trade_ts) as first_trade, max(trade_ts) as last_trade
    from e group by all having sum(signed_qty) <> 0""",
    "broker": """
    select trade_date, broker_id, channel, count(*) as trade_count,
           cast(sum(amount) as decimal(24,4)) as volume,
           cast(sum(commission) as decimal(20,4)) as total_commission,
           count(distinct investor_id) as unique_investors,
           count(distinct security_id) as unique_securities
    from e group by all""",
    "bal": """
    select d.investor_id,
           case when c.active then d.security_id else d.security_id + 1000000000 end as security_id,
           cast(sum(case when side = 'BUY' then qty else -qty end)
                + case when max(d.investor_id) % 40 = 0 then 1 else 0 end as decimal(24,4)) as nominal_qty
    from d join c on d.investor_id = c.investor_id
    group by all having sum(case when side = 'BUY' then qty else -qty end) <> 0""",
}


def sql(blocks: str, body: str) -> str:
    """``body`` preceded by the building blocks it names."""
    wanted = blocks.split()
    unknown = set(wanted) - set(_BLOCKS)
    if unknown:
        raise ValueError(f"unknown blocks {unknown}")
    parts = [f"{name} as ({text})" for name, text in _BLOCKS.items() if name in wanted]
    return f"with {', '.join(parts)}\n{body}"


TRADES = "raw t"
LATEST = "raw t d"
SILVER = "raw t d c s e"
FAULTY = "raw f df c listed ef outcome"
