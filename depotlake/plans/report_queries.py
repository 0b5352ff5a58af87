"""Reporting queries, predicates and scalar functions."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from depotlake.functions.expressions import at, human_count, human_size
from depotlake.model import SIDES
from depotlake.operators import calendars, marts, reports
from depotlake.operators.dedup import latest_per_key
from depotlake.operators.joins import join_dimension
from depotlake.plans.lake_queries import silver_trades
from depotlake.plans.registry import LATEST, SILVER, TRADES, query, sql
from depotlake.sources import tables

# The report's quarter and security type on the given tables.
QUARTER = date(1997, 1, 1), date(1997, 3, 31)
SECURITY_TYPE = "PROMO"


@query("quarter_channel_report", sql("raw t s", """
    select channel, count(*) as trade_count, cast(sum(amount) as decimal(24,4)) as volume,
           count(distinct investor_id) as unique_investors
    from t join s on t.security_id = s.security_id
    where security_type = 'PROMO' and trade_date between date '1997-01-01' and date '1997-03-31'
    group by channel"""))
def quarter_channel_report(spark, folder):
    return reports.channel_report_on_source(
        tables.trades(spark, folder), tables.securities(spark, folder), SECURITY_TYPE, *QUARTER)


@query("quarter_channel_on_silver", sql(SILVER, """
    select channel, count(*) as trade_count, cast(sum(amount) as decimal(24,4)) as volume,
           count(distinct investor_id) as unique_investors
    from e where security_type = 'PROMO'
      and trade_date between date '1997-01-01' and date '1997-03-31'
    group by channel"""))
def quarter_channel_on_silver(spark, folder):
    return reports.channel_report(silver_trades(spark, folder), SECURITY_TYPE, *QUARTER)


@query("quarter_channel_from_gold", sql(SILVER + " daily", """
    select channel, sum(trade_count)::bigint as trade_count,
           cast(sum(volume) as decimal(24,4)) as volume
    from daily where security_type = 'PROMO'
      and trade_date between date '1997-01-01' and date '1997-03-31'
    group by channel"""))
def quarter_channel_from_gold(spark, folder):
    daily = marts.daily_security(silver_trades(spark, folder))
    return reports.channel_report_on_mart(daily, SECURITY_TYPE, *QUARTER)


@query("top_securities", sql("raw t s", """
    select t.security_id, short_code, security_type, count(*) as trade_count,
           cast(sum(amount) as decimal(24,4)) as volume,
           count(distinct investor_id) as unique_investors
    from t join s on t.security_id = s.security_id
    group by all order by volume desc, security_id limit 10"""))
def top_securities(spark, folder):
    return reports.top_securities(tables.trades(spark, folder), tables.securities(spark, folder))


@query("quarter_top10_from_gold", sql(SILVER + " daily", """
    select security_id, short_code, cast(sum(volume) as decimal(24,4)) as volume,
           sum(trade_count)::bigint as trade_count
    from daily where trade_date between date '1997-01-01' and date '1997-03-31'
    group by all order by volume desc, security_id limit 10"""))
def quarter_top10_from_gold(spark, folder):
    return reports.top_on_mart(marts.daily_security(silver_trades(spark, folder)), *QUARTER)


@query("monthly_channel_trend", sql(TRADES, """
    select cast(date_trunc('month', trade_date) as date) as month, channel,
           count(*) as trade_count,
           cast(cast(cast(sum(amount) as double) / 1e6 as decimal(27,5)) as decimal(24,2)) as volume_millions
    from t group by 1, 2"""))
def monthly_channel_trend(spark, folder):
    return reports.monthly_channel_trend(tables.trades(spark, folder))


@query("channel_summary", sql(TRADES, """
    select channel, count(*) as trade_count,
           cast(cast(cast(sum(amount) as double) / 1e9 as decimal(27,5)) as decimal(24,2)) as volume_billions,
           count(distinct investor_id) as unique_investors
    from t group by channel"""))
def channel_summary(spark, folder):
    return reports.channel_summary(tables.trades(spark, folder))


@query("table_totals", sql(TRADES, """
    select count(*) as trade_count, cast(sum(amount) as decimal(24,4)) as volume,
           cast(cast(cast(sum(amount) as double) / count(amount) as decimal(27,7)) as decimal(24,4)) as mean_amount from t"""))
def table_totals(spark, folder):
    return reports.totals(tables.trades(spark, folder))


@query("closed_account_volume", sql(LATEST + " c", """
    select investor_type, count(*) as trade_count, cast(sum(amount) as decimal(24,4)) as volume
    from d join c on d.investor_id = c.investor_id where not active group by investor_type"""))
def closed_account_volume(spark, folder):
    return reports.closed_account_volume(latest_per_key(tables.trades(spark, folder)),
                                         tables.investors(spark, folder))


@query("speedup_ratio", sql(TRADES, """
    select channel, trade_count,
           cast(cast(max(trade_count) over () / greatest(trade_count, 1) as decimal(27,7)) as decimal(24,4)) as factor
    from (select channel, count(*) as trade_count from t group by channel)"""))
def speedup_ratio(spark, folder):
    counts = tables.trades(spark, folder).groupBy("channel").agg(
        F.count(F.lit(1)).alias("trade_count"))
    return reports.speedup(counts, "channel", "trade_count")


@query("month_total", sql(TRADES, """
    select count(*) as trade_count, cast(sum(amount) as decimal(24,4)) as volume,
           cast(cast(cast(sum(amount) as double) / count(amount) as decimal(27,7)) as decimal(24,4)) as mean_amount
    from t where trade_ts >= timestamp '1997-03-01' and trade_ts < timestamp '1997-04-01'"""))
def month_total(spark, folder):
    return reports.totals(reports.trades_between(
        tables.trades(spark, folder), datetime(1997, 3, 1), datetime(1997, 4, 1)))


@query("filter_predicates", sql("raw f df c s", """
    select count(*) filter (amount > 50000) as greater,
           count(*) filter (trade_date between date '1997-01-01' and date '1997-03-31') as in_quarter,
           count(*) filter (trade_ts >= timestamp '1997-03-01' and trade_ts < timestamp '1997-04-01')
               as in_month,
           count(*) filter (side in ('BUY', 'SELL')) as known_side,
           count(*) filter (side not in ('BUY', 'SELL')) as unknown_side,
           count(*) filter (channel like '%URGENT%') as urgent,
           count(*) filter (amount is null) as no_amount,
           count(*) filter (amount is not null) as with_amount,
           count(*) filter (not active) as inactive,
           count(*) filter (active and qty >= 25) as active_large
    from df join c on df.investor_id = c.investor_id"""))
def filter_predicates(spark, folder):
    rows = join_dimension(latest_per_key(tables.faulty_trades(spark, folder)),
                          tables.investors(spark, folder), "investor_id", how="inner")
    stamp = F.col("trade_ts")
    month = (stamp >= at(datetime(1997, 3, 1))) & (stamp < at(datetime(1997, 4, 1)))
    tests = {
        "greater": F.col("amount") > 50000,
        "in_quarter": reports.date_between(*QUARTER),
        "in_month": month,
        "known_side": F.col("side").isin(*SIDES),
        "unknown_side": ~F.col("side").isin(*SIDES),
        "urgent": F.col("channel").like("%URGENT%"),
        "no_amount": F.col("amount").isNull(),
        "with_amount": F.col("amount").isNotNull(),
        "inactive": ~F.col("active"),
        "active_large": F.col("active") & (F.col("qty") >= 25),
    }
    return rows.agg(*(F.count_if(test).alias(name) for name, test in tests.items()))


@query("label_case", sql(TRADES, """
    select case when amount >= 70000 then 'block' when amount >= 20000 then 'large'
                when amount > 0 then 'retail' else 'other' end as label,
           case when side = 'BUY' then 'in' else 'out' end as direction,
           count(*) as trade_count
    from t group by 1, 2"""))
def label_case(spark, folder):
    amount = F.col("amount")
    label = (F.when(amount >= 70000, "block").when(amount >= 20000, "large")
             .when(amount > 0, "retail").otherwise("other"))
    direction = F.when(F.col("side") == "BUY", "in").otherwise("out")
    return tables.trades(spark, folder).groupBy(
        label.alias("label"), direction.alias("direction")).agg(
        F.count(F.lit(1)).alias("trade_count"))


@query("business_calendar", sql(TRADES, """
    select (row_number() over (order by day) - 1)::int as idx, day from (
        select cast(unnest(generate_series(lo, hi, interval 1 day)) as date) as day
        from (select cast(min(trade_date) as timestamp) as lo,
                     cast(max(trade_date) as timestamp) as hi from t))
    where isodow(day) < 6"""))
def business_calendar(spark, folder):
    return calendars.business_calendar(tables.trades(spark, folder))


@query("calendar_join", sql(TRADES, """
    select idx, day, count(*) as trade_count, cast(sum(amount) as decimal(24,4)) as volume
    from t join (
        select (row_number() over (order by day) - 1)::int as idx, day from (
            select cast(unnest(generate_series(lo, hi, interval 1 day)) as date) as day
            from (select cast(min(trade_date) as timestamp) as lo,
                         cast(max(trade_date) as timestamp) as hi from t))
        where isodow(day) < 6) on trade_date = day
    group by idx, day"""))
def calendar_join(spark, folder):
    return calendars.business_day_volume(tables.trades(spark, folder))


@query("scalar_numeric", sql(TRADES, """
    select trade_id, cast(abs(-amount) as decimal(20,4)) as abs_amount,
           cast(-qty as decimal(18,4)) as minus_qty,
           cast(qty + 1 as decimal(20,4)) as plus_one,
           round(cast(amount as double) / 7, 2) as a_seventh,
           cast(floor(cast(price as double)) as bigint) as whole_price,
           cast(power(cast(qty as double), 2) as double) as squared,
           trade_id % 9 as remainder, greatest(investor_id, security_id) as greater_id,
           cast(round(price, 2) as decimal(18,2)) as rounded_price
    from t"""))
def scalar_numeric(spark, folder):
    return tables.trades(spark, folder).select(
        "trade_id",
        F.abs(-F.col("amount")).cast("decimal(20,4)").alias("abs_amount"),
        (-F.col("qty")).cast("decimal(18,4)").alias("minus_qty"),
        (F.col("qty") + 1).cast("decimal(20,4)").alias("plus_one"),
        F.round(F.col("amount").cast("double") / 7, 2).alias("a_seventh"),
        F.floor(F.col("price").cast("double")).alias("whole_price"),
        F.pow(F.col("qty").cast("double"), F.lit(2)).alias("squared"),
        (F.col("trade_id") % 9).alias("remainder"),
        F.greatest("investor_id", "security_id").alias("greater_id"),
        F.round("price", 2).cast("decimal(18,2)").alias("rounded_price"),
    )


@query("scalar_string", """
    select p_partkey, p_brand || ' / ' || p_type as title, rpad(p_brand, 10, '.') as padded,
           lower(p_type) as lower_type, trim(p_type, 'EL') as trimmed,
           concat_ws('-', p_brand, null, p_size) as code, replace(p_type, ' ', '') as joined,
           split_part(p_type, ' ', 2) as finish, length(p_name) as name_length,
           reverse(p_brand) as backwards, p_type like '%BRASS' as is_brass,
           sha256(p_name) as name_digest, cast(p_size as varchar) as as_text,
           coalesce(nullif(p_size, 1), 0)::int as size_or_zero,
           map_extract(map {'BRASS': 'yellow', 'COPPER': 'red', 'STEEL': 'grey'},
                       split_part(p_type, ' ', 3))[1] as colour,
           list_sort(string_split(p_type, ' '))[1] as first_word
    from part""")
def scalar_string(spark, folder):
    """Functions on the part table: one column for each."""
    words = F.split("p_type", " ")
    colours = F.create_map(*map(F.lit, ("BRASS", "yellow", "COPPER", "red", "STEEL", "grey")))
    return tables.table(spark, folder, "part").select(
        "p_partkey",
        F.concat("p_brand", F.lit(" / "), "p_type").alias("title"),
        F.rpad("p_brand", 10, ".").alias("padded"),
        F.lower("p_type").alias("lower_type"),
        F.trim("p_type", F.lit("EL")).alias("trimmed"),
        F.concat_ws("-", "p_brand", F.lit(None).cast("string"), F.col("p_size").cast("string")).alias("code"),
        F.replace(F.col("p_type"), F.lit(" "), F.lit("")).alias("joined"),
        F.split_part("p_type", F.lit(" "), F.lit(2)).alias("finish"),
        F.length("p_name").cast("bigint").alias("name_length"),
        F.reverse("p_brand").alias("backwards"),
        F.col("p_type").like("%BRASS").alias("is_brass"),
        F.sha2("p_name", 256).alias("name_digest"),
        F.col("p_size").cast("string").alias("as_text"),
        F.coalesce(F.nullif(F.col("p_size"), F.lit(1)), F.lit(0)).cast("int").alias("size_or_zero"),
        colours[F.split_part("p_type", F.lit(" "), F.lit(3))].alias("colour"),
        F.array_sort(words)[0].alias("first_word"),
    )


@query("scalar_datetime", """
    select event_id, cast(hour(ts) as int) as hour_of_day,
           cast(date_trunc('month', ts) as date) as month, strftime(ts, '%Y%m') as yyyymm,
           cast(year(ts) as int) as year, cast(isodow(ts) as int) as weekday,
           cast(ts as date) as day, cast(ts as date) + 7 as next_week,
           ts + interval 90 minute as later, ts - interval 3 hour as istanbul_to_utc,
           ts >= timestamp '2024-01-15 00:00:00' as second_half
    from events""")
def scalar_datetime(spark, folder):
    stamp = F.col("ts")
    return tables.table(spark, folder, "events").select(
        "event_id",
        F.hour(stamp).alias("hour_of_day"),
        F.trunc(stamp, "MM").alias("month"),
        F.date_format(stamp, "yyyyMM").alias("yyyymm"),
        F.year(stamp).alias("year"),
        (F.weekday(stamp) + 1).alias("weekday"),
        F.to_date(stamp).alias("day"),
        F.date_add(F.to_date(stamp), 7).alias("next_week"),
        (stamp + F.make_dt_interval(mins=F.lit(90))).alias("later"),
        F.convert_timezone(F.lit("Europe/Istanbul"), F.lit("UTC"), stamp).alias("istanbul_to_utc"),
        (stamp >= at(datetime(2024, 1, 15))).alias("second_half"),
    )


@query("formatted_totals", """
    with k as (select o_orderpriority as priority, count(*) as n, cast(sum(o_custkey) * 100 as bigint) as total
               from orders group by all)
    select priority, case when n >= 1000000 then format('{:,.2f} million', n / 1000000)
                          when n >= 1000 then format('{:,.2f} thousand', n / 1000)
                          else format('{:,.2f}', n::double) end as orders,
           case when total >= 1073741824 then format('{:,.2f} GiB', total / 1073741824)
                when total >= 1048576 then format('{:,.2f} MiB', total / 1048576)
                when total >= 1024 then format('{:,.2f} KiB', total / 1024)
                else format('{:,.2f} B', total::double) end as size
    from k""")
def formatted_totals(spark, folder):
    """Numbers as a reader sees them: a count of rows, and a number of bytes."""
    totals = tables.table(spark, folder, "orders").groupBy(F.col("o_orderpriority").alias("priority")).agg(
        F.count(F.lit(1)).alias("n"), (F.sum("o_custkey") * 100).alias("bytes"))
    return totals.select("priority", human_count(F.col("n")).alias("orders"), human_size(F.col("bytes")).alias("size"))


@query("row_counts_union", sql(TRADES, """
    select 'customer' as source, count(*) as n from customer
    union all select 'part', count(*) from part
    union all select 'orders', count(*) from orders
    union all select 'lineitem', count(*) from lineitem
    union all select 'trade', count(*) from t"""))
def row_counts_union(spark, folder):
    frames = {name: tables.table(spark, folder, name)
              for name in ("customer", "part", "orders", "lineitem")}
    frames["trade"] = tables.trades(spark, folder)
    counts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("source"), "n")
              for name, df in frames.items()]
    union = counts[0]
    for one in counts[1:]:
        union = union.unionByName(one)
    return union
