"""Sinks, upserts, versions and evolution: written, read back, compared."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depotlake.functions.expressions import at, by_bucket, by_day, by_year, month_of, total
from depotlake.model import LATEST_FIRST, REQUIRED, TRADE
from depotlake.operators import evolution, marts, quality, upkeep
from depotlake.operators.dedup import latest_per_key
from depotlake.operators.reports import midnight, totals
from depotlake.operators.upsert import (merge, resent_batch, sample_batch, update_all,
                                        update_where, upsert_into)
from depotlake.operators.versions import version_diff
from depotlake.operators.quality import null_rules
from depotlake.plans.jobs import DAILY_MONTHLY, MONTHLY, audit_bronze
from depotlake.plans.lake_queries import silver_trades
from depotlake.plans.registry import LATEST, SILVER, TRADES, query, sql
from depotlake.plans.report_queries import QUARTER
from depotlake.session import shuffles_removed, workspace
from depotlake.sources import tables, writers
from depotlake.sources.store import MAIN, Store
from depotlake.streaming.ingest import stream_upsert

# Fixed values of the scenarios on the given tables.
CUTOVER = datetime(2001, 1, 1)
HISTORY_END, FEED_START = datetime(2000, 1, 1), datetime(1999, 7, 1)
KEY_SHIFT, LATE_CHANNEL = 3_000_000_000, "LATE FILE"


def new_store(spark: SparkSession, purpose: str) -> Store:
    return Store(spark, workspace(spark, purpose))


def trade_store(spark: SparkSession, folder: str, purpose: str) -> Store:
    """A store whose main shows the latest version of every trade, by month."""
    store = new_store(spark, purpose)
    store.write("trade", latest_per_key(tables.trades(spark, folder)), MAIN, "load",
                MONTHLY, ("trade_ts",))
    return store


def labelled(df: DataFrame, label: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("trade_count"),
                  total("amount", "decimal(24,4)").alias("volume")).select(
        F.lit(label).alias("version"), "trade_count", "volume")


def _plain(df: DataFrame) -> DataFrame:
    return df.select(*TRADE.names)


# ---- sinks

@query("append_batch", sql(TRADES, "select * from t"))
def append_batch(spark, folder):
    path = workspace(spark, "append")
    rows = tables.trades(spark, folder).withColumn("trade_month", month_of("trade_ts"))
    writers.append(rows.filter(F.col("trade_ts") < at(CUTOVER)), path, ["trade_month"])
    writers.append(rows.filter(F.col("trade_ts") >= at(CUTOVER)), path, ["trade_month"])
    return _plain(spark.read.parquet(path))


@query("partition_overwrite", sql(TRADES, """
    select * replace (cast(case when trade_ts >= timestamp '2001-01-01' then amount * 2
                                else amount end as decimal(20,4)) as amount) from t"""))
def partition_overwrite(spark, folder):
    """An increment replaces the months it has rows for and leaves the others."""
    path = workspace(spark, "overwrite")
    rows = tables.trades(spark, folder).withColumn("trade_month", month_of("trade_ts"))
    writers.full_refresh(rows, path, ["trade_month"], ["trade_ts"])
    increment = update_all(rows.filter(F.col("trade_ts") >= at(CUTOVER)),
                           {"amount": F.col("amount") * 2})
    writers.overwrite_partitions(increment, path, ["trade_month"], ["trade_ts"])
    return _plain(spark.read.parquet(path))


@query("full_refresh_idempotent", sql(TRADES, """
    select * from t where trade_ts < timestamp '2001-01-01'"""))
def full_refresh_idempotent(spark, folder):
    """A second full load, twice, from a source that has shrunk leaves nothing behind."""
    path, source = workspace(spark, "refresh"), workspace(spark, "refresh-source")
    # The three loads read one delivery, so that the trades are put together once.
    with shuffles_removed(spark):
        tables.trades(spark, folder).write.parquet(source)
        rows = spark.read.parquet(source).withColumn("trade_month", month_of("trade_ts"))
        writers.full_refresh(rows, path, ["trade_month"])
        shrunk = rows.filter(F.col("trade_ts") < at(CUTOVER))
        for _ in range(2):
            writers.full_refresh(shrunk, path, ["trade_month"])
    return _plain(spark.read.parquet(path))


_QUARTER_COLUMNS = ("trade_id", "investor_id", "security_id", "trade_ts", "trade_date", "side",
                    "qty", "price", "amount", "commission", "short_code", "security_type")
_QUARTER_SQL = f"""select {', '.join(_QUARTER_COLUMNS)} from e
    where trade_ts >= timestamp '1997-01-01' and trade_ts < timestamp '1997-04-01'"""


def quarter_store(spark: SparkSession, folder: str, purpose: str) -> Store:
    """A new table from a selection of silver: one quarter, twelve columns."""
    stamp = F.col("trade_ts")
    rows = silver_trades(spark, folder).filter(
        (stamp >= at(midnight(QUARTER[0]))) & (stamp < at(datetime(1997, 4, 1))))
    store = new_store(spark, purpose)
    store.write("quarter", rows.select(*_QUARTER_COLUMNS), MAIN, "create", MONTHLY, ("trade_ts",))
    return store


@query("ctas_quarter", sql(SILVER, _QUARTER_SQL))
def ctas_quarter(spark, folder):
    return quarter_store(spark, folder, "ctas").read("quarter").select(*_QUARTER_COLUMNS)


@query("serving_daily", sql(SILVER + " daily", "select * from daily"))
def serving_daily(spark, folder):
    store = new_store(spark, "serving")
    daily = marts.daily_security(silver_trades(spark, folder))
    store.write("serving", daily, MAIN, "refresh", DAILY_MONTHLY,
                ("trade_date", "security_type", "security_id", "channel"), grouped=True)
    return store.read("serving").select(*daily.columns)


# ---- row-level changes

_MERGE_SQL = """
    select * exclude (origin, rn) from (
        select *, row_number() over (partition by trade_id order by updated_ts desc, origin) as rn
        from (select * exclude (rn), 0 as origin from (
                  select *, row_number() over (partition by trade_id
                      order by updated_ts desc, security_id desc, broker_id desc) as rn
                  from t where updated_ts < timestamp '2000-01-01') where rn = 1
              union all
              select * exclude (rn) replace (cast(qty * 2 as decimal(18,4)) as qty), 1 as origin from (
                  select *, row_number() over (partition by trade_id
                      order by updated_ts desc, security_id desc, broker_id desc) as rn
                  from t where updated_ts >= timestamp '1999-07-01') where rn = 1))
    where rn = 1"""


def _history_and_feed(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Trades up to a date, and a feed that starts half a year before it with
    doubled quantities, so that it shows which side of the overlap won."""
    trades = tables.trades(spark, folder)
    stamp = F.col("updated_ts")
    history = latest_per_key(trades.filter(stamp < at(HISTORY_END)))
    feed = update_all(trades.filter(stamp >= at(FEED_START)), {"qty": F.col("qty") * 2})
    return history, feed


@query("merge_upsert", sql(TRADES, _MERGE_SQL))
def merge_upsert(spark, folder):
    return merge(*_history_and_feed(spark, folder))


@query("upsert_stored", sql(TRADES, _MERGE_SQL))
def upsert_stored(spark, folder):
    """The same upsert on a stored table: only parts with a replaced row are rewritten."""
    history, feed = _history_and_feed(spark, folder)
    store = new_store(spark, "upsert-stored")
    store.write("trade", history, MAIN, "load", MONTHLY, ("trade_ts",))
    upsert_into(store, "trade", feed, MAIN, sort_by=("trade_ts",))
    return _plain(store.read("trade"))


@query("version_diff", sql(TRADES, f"""select * from (
    with tgt as (select * exclude (rn) from (select *, row_number() over (partition by trade_id
                     order by updated_ts desc, security_id desc, broker_id desc) as rn
                     from t where updated_ts < timestamp '2000-01-01') where rn = 1),
         res as ({_MERGE_SQL})
    select count(*) filter (tgt.trade_id is null) as added,
           count(*) filter (res.trade_id is null) as removed,
           count(*) filter (tgt.trade_id is not null and res.trade_id is not null
                            and (tgt.qty <> res.qty or tgt.updated_ts <> res.updated_ts
                                 or tgt.amount <> res.amount)) as changed
    from tgt full join res on tgt.trade_id = res.trade_id)"""))
def changed_by_upsert(spark, folder):
    """What the upsert added and changed; parts both versions share are not read."""
    history, feed = _history_and_feed(spark, folder)
    store = new_store(spark, "diff")
    store.write("trade", history, MAIN, "load", MONTHLY, ("trade_ts",))
    upsert_into(store, "trade", feed, MAIN, sort_by=("trade_ts",))
    return version_diff(store, "trade", 1, 2)


@query("stream_upsert", sql(LATEST, "select * from d"))
def streamed(spark, folder):
    """All trade messages as change files in four micro-batches: the table ends
    up with the latest version of every trade."""
    scratch = workspace(spark, "stream")
    files = tables.tasks_for_trades(spark, folder, 4)
    feed = tables.trades(spark, folder).repartitionByRange(files, "updated_ts")
    feed.write.parquet(f"{scratch}/feed")
    store = Store(spark, f"{scratch}/store")
    stream_upsert(store, "trade", f"{scratch}/feed", TRADE, f"{scratch}/checkpoint",
                  "stream_upsert", lambda batch: audit_bronze(batch, unique=False, rules=null_rules(REQUIRED)),
                  layout=MONTHLY, sort_by=("trade_ts",), files_per_batch=files // 4)
    return _plain(store.read("trade"))


@query("update_all", sql(LATEST, """
    select * replace (cast(amount * 100 as decimal(20,4)) as amount) from d"""))
def update_every_row(spark, folder):
    return update_all(latest_per_key(tables.trades(spark, folder)), {"amount": F.col("amount") * 100})


@query("update_where", sql("raw f", """
    select * replace (cast(case when qty < 0 then -qty else qty end as decimal(18,4)) as qty) from f"""))
def update_some_rows(spark, folder):
    return update_where(tables.faulty_trades(spark, folder), F.col("qty") < 0, {"qty": -F.col("qty")})


@query("dirty_batch", sql(LATEST, """
    select * from d union all
    select * replace (trade_id + 3000000000 as trade_id,
                      cast(amount * 100 as decimal(20,4)) as amount, 'LATE FILE' as channel) from d"""))
def dirty_batch(spark, folder):
    rows = latest_per_key(tables.trades(spark, folder))
    return rows.unionByName(resent_batch(rows, KEY_SHIFT, LATE_CHANNEL))


@query("sample_batch", sql(TRADES, """
    select * from t order by trade_id, updated_ts desc, security_id desc, broker_id desc limit 50"""))
def first_rows(spark, folder):
    order = ["trade_id", *(F.desc(c) for c in LATEST_FIRST)]
    return sample_batch(tables.trades(spark, folder), order, 50)


# ---- versions

def corrupted_store(spark: SparkSession, folder: str, purpose: str) -> Store:
    """Version 1 is right; version 2 has every amount times 100."""
    store = trade_store(spark, folder, purpose)
    store.write("trade", update_all(_plain(store.read("trade")), {"amount": F.col("amount") * 100}),
                MAIN, "update", sort_by=("trade_ts",))
    return store


_D_TOTALS = "count(*) as trade_count, cast(sum(amount) as decimal(24,4)) as volume"
_D_TIMES_100 = "count(*) as trade_count, cast(sum(amount * 100) as decimal(24,4)) as volume"


@query("version_as_of", sql(LATEST, "select * from d"))
def version_as_of(spark, folder):
    return _plain(corrupted_store(spark, folder, "as-of").read("trade", version=1))


@query("version_compare", sql(LATEST, f"""
    select 'before' as version, {_D_TOTALS} from d
    union all select 'after', {_D_TIMES_100} from d"""))
def version_compare(spark, folder):
    store = corrupted_store(spark, folder, "compare")
    return labelled(store.read("trade", version=1), "before").unionByName(
        labelled(store.read("trade"), "after"))


@query("rollback", sql(LATEST, f"""
    select 'main' as version, {_D_TOTALS} from d
    union all select 'bad version', {_D_TIMES_100} from d"""))
def rollback(spark, folder):
    store = corrupted_store(spark, folder, "rollback")
    store.rollback("trade", 1)
    return labelled(store.read("trade"), "main").unionByName(
        labelled(store.read("trade", version=2), "bad version"))


@query("version_log", sql(LATEST, """
    select 1 as version, 'load' as operation, count(*) as rows_written, true as is_current from d
    union all select 2, 'update', count(*), false from d"""))
def version_log(spark, folder):
    store = corrupted_store(spark, folder, "log")
    store.rollback("trade", 1)
    return store.log("trade").select("version", "operation", "rows_written", "is_current")


@query("current_version", sql(LATEST, """
    select 1 as newest_ancestor, 2 as newest_written, count(*) as trade_count from d"""))
def current_version(spark, folder):
    """After a rollback the current version is not the newest one written."""
    store = corrupted_store(spark, folder, "current")
    store.rollback("trade", 1)
    rows = store.read("trade").agg(F.count(F.lit(1)).alias("n")).scalar()
    current = F.max_by(F.when(F.col("is_current"), F.col("version")),
                       F.when(F.col("is_current"), F.col("made_at")))
    return store.log("trade").agg(
        current.alias("newest_ancestor"),
        F.max_by("version", "made_at").alias("newest_written")).withColumn("trade_count", rows)


_RESENT = "count(*) * 2 as trade_count, cast(sum(amount) * 101 as decimal(24,4)) as volume"


@query("wap_isolation", sql(LATEST, f"""
    select 'main' as version, {_D_TOTALS} from d union all select 'stage', {_RESENT} from d"""))
def wap_isolation(spark, folder):
    """A faulty delivery on a stage is invisible on main."""
    store = trade_store(spark, folder, "isolation")
    store.create_ref("stage")
    store.append("trade", resent_batch(_plain(store.read("trade")), KEY_SHIFT, LATE_CHANNEL), "stage")
    return labelled(store.read("trade"), "main").unionByName(
        labelled(store.read("trade", "stage"), "stage"))


@query("wap_repair", sql(LATEST, """
    select * from d union all
    select * replace (trade_id + 3000000000 as trade_id, 'LATE FILE' as channel) from d"""))
def wap_repair(spark, folder):
    """The delivery is audited and repaired on the stage, then published."""
    store = trade_store(spark, folder, "repair")
    store.create_ref("stage")
    store.append("trade", resent_batch(_plain(store.read("trade")), KEY_SHIFT, LATE_CHANNEL), "stage")
    hundredths = F.col("amount") > F.col("qty") * F.col("price") * 50
    rules = {"amount in hundredths": hundredths}
    if not quality.findings(quality.violations(store.read("trade", "stage"), rules)):
        raise quality.QualityError("the audit overlooked the faulty delivery")
    staged = _plain(store.read("trade", "stage"))
    store.write("trade", update_where(staged, hundredths, {"amount": F.col("amount") / 100}),
                "stage", "repair", sort_by=("trade_ts",))
    quality.require_clean(quality.violations(store.read("trade", "stage"), rules), "stage")
    store.publish("stage")
    return _plain(store.read("trade"))


# ---- evolution

# The quarter learns what a trade costs to settle; buys of February that were re-priced come with it.
_NEW = {"settle_days": "int", "settle_fee": "decimal(12,4)"}
_FEBRUARY = (datetime(1997, 2, 1), datetime(1997, 3, 1))


def evolved_store(spark: SparkSession, folder: str, purpose: str, layout=None) -> Store:
    """The quarter with two columns more and a delivery that fills them."""
    store = quarter_store(spark, folder, purpose)
    old = store.read("quarter").select(*_QUARTER_COLUMNS)
    evolution.add_columns(store, "quarter", MAIN, _NEW)
    if layout:
        evolution.change_layout(store, "quarter", MAIN, layout)
    stamp = F.col("trade_ts")
    late = old.filter((stamp >= at(_FEBRUARY[0])) & (stamp < at(_FEBRUARY[1])) & (F.col("side") == "BUY")).withColumns({
        "trade_id": -F.col("trade_id"), "settle_days": (F.col("security_id") % 3).cast("int"),
        "settle_fee": (F.col("amount") / 1000).cast("decimal(12,4)")})
    store.append("quarter", late, MAIN, ("trade_ts",))
    return store


_EVOLVED_SQL = f"""
    select {', '.join(_QUARTER_COLUMNS)}, cast(null as int) as settle_days,
           cast(null as decimal(12,4)) as settle_fee from q
    union all
    select {', '.join(_QUARTER_COLUMNS).replace('trade_id', '-trade_id')},
           (security_id % 3)::int, cast(cast(amount as decimal(24,7)) * 0.001 as decimal(12,4)) from q
    where trade_ts >= timestamp '1997-02-01' and trade_ts < timestamp '1997-03-01' and side = 'BUY'"""


def _quarter_sql(body: str) -> str:
    return sql(SILVER, f"select * from (with q as ({_QUARTER_SQL}) {body})")


@query("schema_add_columns", _quarter_sql(_EVOLVED_SQL))
def schema_add_columns(spark, folder):
    store = evolved_store(spark, folder, "add-columns")
    return store.read("quarter").select(*_QUARTER_COLUMNS, *_NEW)


_MIXED_SQL = f"""select count(*) as total, count(*) filter (settle_fee is null) as old_schema,
    count(*) filter (settle_fee is not null) as new_schema from ({_EVOLVED_SQL})"""


def _mixed(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total"),
                  F.count_if(F.col("settle_fee").isNull()).alias("old_schema"),
                  F.count_if(F.col("settle_fee").isNotNull()).alias("new_schema"))


@query("mixed_schema_counts", _quarter_sql(_MIXED_SQL))
def mixed_schema_counts(spark, folder):
    return _mixed(evolved_store(spark, folder, "mixed").read("quarter"))


@query("partition_evolution", _quarter_sql(_MIXED_SQL))
def partition_evolution(spark, folder):
    """Months before, days after: one query reads both."""
    store = evolved_store(spark, folder, "layout", {"trade_day": by_day("trade_ts")})
    return _mixed(store.read("quarter"))


@query("partition_evolution_buckets", _quarter_sql(_MIXED_SQL))
def partition_evolution_buckets(spark, folder):
    """Months before, years and buckets of the key after."""
    layout = {"trade_year": by_year("trade_ts"), "key_bucket": by_bucket("trade_id", 4)}
    return _mixed(evolved_store(spark, folder, "buckets", layout).read("quarter"))


@query("layout_folders", sql(TRADES, """
    select 'trade_year=' || year(trade_ts) as folder, count(*) as rows, true as has_files from t group by all"""))
def layout_folders(spark, folder):
    """The inventory of a table laid out by years against its rows: every folder listed, none besides."""
    store = new_store(spark, "folders")
    store.write("trade", tables.trades(spark, folder), MAIN, "load", {"trade_year": by_year("trade_ts")})
    listed = upkeep.per_partition(upkeep.live_files(store, "trade"))
    held = store.read("trade").groupBy(F.concat(F.lit("trade_year="), F.col("trade_year")).alias("folder")).agg(
        F.count(F.lit(1)).alias("rows"))
    return listed.join(held, F.col("partition") == F.col("folder"), "full").select(
        F.coalesce("folder", "partition").alias("folder"), F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"),
        F.coalesce((F.col("files") > 0) & (F.col("bytes") > 0), F.lit(False)).alias("has_files"))


@query("schema_rename", _quarter_sql("""
    select * exclude (commission), commission as commission_amount from q"""))
def schema_rename(spark, folder):
    store = quarter_store(spark, folder, "rename")
    evolution.rename_column(store, "quarter", MAIN, "commission", "commission_amount")
    return store.read("quarter").drop("trade_month")


@query("schema_widen", _quarter_sql("""
    select * replace (cast(price as decimal(20,6)) as price) from q"""))
def schema_widen(spark, folder):
    store = quarter_store(spark, folder, "widen")
    evolution.widen_column(store, "quarter", MAIN, "price", "decimal(20,6)")
    return store.read("quarter").drop("trade_month")


@query("old_version_old_schema", _quarter_sql("select * from q"))
def old_version_old_schema(spark, folder):
    """A version is read with the columns it had, whatever came later."""
    return evolved_store(spark, folder, "old-schema").read("quarter", version=1).drop("trade_month")


_HALVES = ("trade_ts < timestamp '1997-02-15'", "trade_ts >= timestamp '1997-02-15'")


def half_store(spark: SparkSession, folder: str, purpose: str) -> tuple[Store, DataFrame]:
    """The first half of the quarter in a table, and the second half."""
    rows = quarter_store(spark, folder, purpose).read("quarter").select(*_QUARTER_COLUMNS)
    store = new_store(spark, purpose)
    store.write("half", rows.filter(_HALVES[0]), MAIN, "load", MONTHLY)
    return store, rows.filter(_HALVES[1])


@query("append_narrower", _quarter_sql(f"""
    select * replace (case when {_HALVES[0]} then commission end as commission),
           case when {_HALVES[1]} then side end as flag from q"""))
def append_narrower(spark, folder):
    """A delivery without one column, and a later one with a new column: the absent one is
    NULL there, and the new one is not taken for it."""
    store, rest = half_store(spark, folder, "narrower")
    store.append("half", rest.drop("commission").limit(0), MAIN)
    store.append("half", rest.drop("commission").withColumn("flag", F.col("side")), MAIN)
    return store.read("half").select(*_QUARTER_COLUMNS, "flag")


@query("append_after_widen", _quarter_sql(f"""
    select * replace (cast(case when {_HALVES[0]} then cast(price as decimal(28,6)) * 100000000 else price end as decimal(28,6)) as price)
    from q"""))
def append_after_widen(spark, folder):
    """An append of the old type does not narrow a widened column again."""
    store, rest = half_store(spark, folder, "widened")
    evolution.widen_column(store, "half", MAIN, "price", "decimal(28,6)")
    large = store.read("half").select(*_QUARTER_COLUMNS).withColumn(
        "price", (F.col("price") * 100_000_000).cast("decimal(28,6)"))
    store.write("half", large, MAIN, "update")
    store.append("half", rest, MAIN)
    return store.read("half").select(*_QUARTER_COLUMNS)


@query("rename_partition_source", _quarter_sql("select * exclude (trade_ts), trade_ts as traded_at from q"))
def rename_partition_source(spark, folder):
    """The layout follows when the column it is derived from gets another name."""
    store, rest = half_store(spark, folder, "renamed")
    evolution.rename_column(store, "half", MAIN, "trade_ts", "traded_at")
    store.append("half", rest.withColumnRenamed("trade_ts", "traded_at"), MAIN)
    names = ["traded_at" if c == "trade_ts" else c for c in _QUARTER_COLUMNS]
    return store.read("half").select(*names)


_ODD = """case trade_id % 6 when 0 then '' when 1 then null when 2 then 'a/b=c' when 3 then '50% +x'
          when 4 then ' ' else channel end"""


@query("odd_partition_values", sql(LATEST, f"select * replace ({_ODD} as channel) from d"))
def odd_partition_values(spark, folder):
    """Empty, missing and odd values of a column that the layout is derived from come back as they were."""
    store = new_store(spark, "odd")
    rows = latest_per_key(tables.trades(spark, folder)).withColumn("channel", F.expr(_ODD))
    store.write("trade", rows, MAIN, "load", {"channel_part": "channel"})
    return _plain(store.read("trade"))


_KEYLESS = "case when trade_id % 5 = 0 then null else trade_id end"


@query("upsert_null_keys", sql(LATEST, f"""
    select * replace ({_KEYLESS} as trade_id) from d
    union all select * replace (null as trade_id) from d where trade_id % 5 = 0"""))
def upsert_null_keys(spark, folder):
    """Rows without a key match nothing: those of the table stay, those of the feed are added. The feed sends the
    rows that were loaded again, as stored, so that the trades are put together and ranked once."""
    rows = latest_per_key(tables.trades(spark, folder)).withColumn("trade_id", F.expr(_KEYLESS))
    store = new_store(spark, "keyless")
    loaded = store.write("trade", rows, MAIN, "load", MONTHLY)
    upsert_into(store, "trade", _plain(store.read("trade", version=loaded)), MAIN)
    return _plain(store.read("trade"))


# ---- upkeep that keeps rows

@query("compact_preserves_rows", sql(LATEST, "select * from d"))
def compact_preserves_rows(spark, folder):
    store = new_store(spark, "compact")
    rows = latest_per_key(tables.trades(spark, folder))
    store.write("trade", rows.filter("side = 'BUY'"), MAIN, "load", MONTHLY)
    store.append("trade", rows.filter("side = 'SELL'"), MAIN)
    upkeep.compact(store, "trade", sort_by=("trade_ts",))
    return _plain(store.read("trade"))


@query("table_totals_as_of", sql(LATEST, """
    select count(*) as trade_count, cast(sum(amount) as decimal(24,4)) as volume,
           cast(cast(cast(sum(amount) as double) / count(amount) as decimal(27,7)) as decimal(24,4)) as mean_amount from d"""))
def table_totals_as_of(spark, folder):
    """The table as main showed it before the accident, by time."""
    store = trade_store(spark, folder, "as-of-time")
    loaded = store.history()[-1]["made_at"]
    store.write("trade", update_all(_plain(store.read("trade")), {"amount": F.col("amount") * 100}),
                MAIN, "update", sort_by=("trade_ts",))
    return totals(store.read("trade", as_of=datetime.fromisoformat(loaded)))
