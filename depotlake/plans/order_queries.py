"""Queries that depend on the order of rows: exact quantiles, as-of joins and an interleaved file order."""

from __future__ import annotations

from pyspark.sql import functions as F

from depotlake.operators.asof import as_of
from depotlake.operators.dedup import latest_per_key
from depotlake.operators.interleave import lookup_cost, write_interleaved
from depotlake.operators.quantiles import exact_quantiles
from depotlake.plans.registry import LATEST, TRADES, query, sql
from depotlake.plans.write_queries import new_store
from depotlake.sources import tables

QUANTILES = ("0.01", "0.25", "0.5", "0.9", "0.99", "1")


@query("amount_percentiles", sql(TRADES, f"""
    select channel, side, unnest([{', '.join(QUANTILES)}])::decimal(9,8) as quantile,
           unnest(quantile_disc(amount, [{', '.join(QUANTILES)}])) as amount
    from t group by channel, side"""))
def amount_percentiles(spark, folder):
    """Exact quantiles of the amounts of a channel and side: few groups, each with a large share of all rows."""
    trades = tables.trades(spark, folder)
    return exact_quantiles(trades, ["channel", "side"], "amount", QUANTILES)


@query("trades_as_of", sql(LATEST, """
    , quotes as (
        select security_id, (trade_date + interval 1 day)::timestamp as quote_ts, min(price) as low, max(price) as high
        from d group by security_id, trade_date)
    select trade_id, d.security_id, d.trade_ts, d.price, quote_ts, low, high
    from d asof left join quotes on d.security_id = quotes.security_id and d.trade_ts >= quotes.quote_ts""".lstrip()))
def trades_as_of(spark, folder):
    """Each trade with the price range of its security on the latest earlier day of trade."""
    trades = latest_per_key(tables.trades(spark, folder)).select("trade_id", "security_id", "trade_ts", "trade_date", "price")
    quotes = trades.groupBy("security_id", "trade_date").agg(F.min("price").alias("low"), F.max("price").alias("high"))
    quotes = quotes.select("security_id", "low", "high", F.date_add("trade_date", 1).cast("timestamp_ntz").alias("quote_ts"))
    return as_of(trades.drop("trade_date"), quotes, ["security_id"], "trade_ts", "quote_ts", ["low", "high"])


FILES = 16


@query("interleaved_layout", sql(TRADES, """
    , middle as (select quantile_disc(investor_id, 0.5) as investor, quantile_disc(trade_date, 0.5) as day from t),
    found as (
        select 'investor_id' as probe, count(*) as rows from t where investor_id = (select investor from middle)
        union all select 'trade_date', count(*) from t where trade_date = (select day from middle))
    select layout, probe, rows, not (layout = 'by investor' and probe = 'trade_date') as skips_half
    from found, (values ('by investor'), ('interleaved')) as layouts(layout)""".lstrip()))
def interleaved_layout(spark, folder):
    """Lookups by investor and by day in a copy sorted by investor and in an interleaved one: the rows found, and
    whether half of the files or more are skipped. Both serve the investor, only the second one the day."""
    store = new_store(spark, "interleaved")
    keys = ["investor_id", "trade_date"]
    tables.trades(spark, folder).select("trade_id", *keys, "qty", "amount").write.parquet(f"{store.root}/source")
    source = spark.read.parquet(f"{store.root}/source")
    source.repartitionByRange(FILES, *keys).sortWithinPartitions(*keys).write.parquet(f"{store.root}/sorted")
    write_interleaved(source, f"{store.root}/interleaved", keys, FILES)
    probes = {key: exact_quantiles(source, [], key, ["0.5"]).first()[key] for key in keys}
    layouts = (("by investor", "sorted"), ("interleaved", "interleaved"))
    reports = []
    for label, name in layouts:
        stored = spark.read.parquet(f"{store.root}/{name}")
        found = stored.agg(*(F.count_if(F.col(key) == F.lit(value)).alias(key) for key, value in probes.items()))
        rows = found.unpivot([], keys, "probe", "rows")
        reports.append(lookup_cost(stored, probes).join(F.broadcast(rows), "probe").select(
            F.lit(label).alias("layout"), "probe", "rows", (F.col("touched") * 2 <= F.col("files")).alias("skips_half")))
    return reports[0].unionByName(reports[1])
