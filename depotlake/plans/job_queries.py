"""The whole chain of jobs, and the checks, views and upkeep on what it published."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from time import perf_counter

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from depotlake.functions.expressions import at, human_count
from depotlake.model import REQUIRED, TRADE
from depotlake.operators import evolution, reconcile, reports, upkeep
from depotlake.operators.quality import null_rules
from depotlake.operators.upsert import resent_batch
from depotlake.plans import jobs
from depotlake.plans.recon_queries import balance
from depotlake.plans.registry import FAULTY, LATEST, SILVER, TRADES, query, sql
from depotlake.plans.report_queries import QUARTER, SECURITY_TYPE
from depotlake.plans.write_queries import (LATE_CHANNEL, KEY_SHIFT, labelled, new_store)
from depotlake.sources import tables
from depotlake.sources.shared_files import SharedFiles, file_inventory, parquet_files
from depotlake.sources.store import FILE, FILE_ROW, MAIN, Store

# The careless feed breaks business rules on purpose; what blocks its ingest is a
# missing identity. The faults go to the quarantine instead.
IDENTITY = ("trade_id", "investor_id", "security_id", "trade_ts", "updated_ts")


# Rows of a file whose order one task looks at together; some 100 MB of memory.
ORDER_BLOCK = 1 << 20


def sorted_inside(rows: DataFrame, column: str, *others: str, block: int = ORDER_BLOCK) -> DataFrame:
    """``column`` and ``others`` of ``rows`` read with their files, with a flag on those that follow a greater value
    in their file.

    Files are known by a hash and cut into blocks of rows, so a task holds neither paths nor a whole file. The last row
    of a block also goes to the next one, where nothing but the first row there is held against it; two files of one
    hash, which is improbable, would be taken for one.
    """
    number = F.floor(F.col(FILE_ROW) / block)
    ends = F.pmod(F.col(FILE_ROW), F.lit(block)) == block - 1
    blocks = F.when(ends, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    placed = rows.select(F.xxhash64(FILE).alias("_of"), F.col(FILE_ROW).alias("_at"), number.alias("_block"), column,
                         *others, F.explode(blocks).alias("_on"))
    placed = placed.withColumn("_block", F.col("_block") + F.col("_on"))
    last = F.lag(column).over(Window.partitionBy("_of", "_block").orderBy("_at"))
    flagged = placed.withColumn("out_of_order", F.coalesce(last > F.col(column), F.lit(False)))
    return flagged.where("_on = 0").select(column, *others, "out_of_order")


_published: dict[tuple, Store] = {}


def published(spark: SparkSession, folder: str) -> Store:
    """All layers built from the clean feed, once per session and state of the
    source files; the queries below read what main shows."""
    state = tuple(SharedFiles(spark).stamps(folder))
    key = (spark.sparkContext.applicationId, folder, state)
    if key not in _published:
        store = new_store(spark, "published")
        jobs.run_all(store, tables.trades(spark, folder), tables.investors(spark, folder),
                     tables.securities(spark, folder), unique=False, rules=null_rules(REQUIRED))
        _published[key] = store
    return _published[key]


def published_faulty(spark: SparkSession, folder: str, purpose: str) -> Store:
    store = new_store(spark, purpose)
    jobs.run_all(store, tables.faulty_trades(spark, folder), tables.investors(spark, folder),
                 tables.listed_securities(spark, folder), unique=False, rules=null_rules(IDENTITY))
    return store


def published_trades(spark: SparkSession, folder: str, purpose: str) -> Store:
    """Only the typed trades, loaded and published."""
    store = new_store(spark, purpose)
    jobs.load_bronze(store, tables.trades(spark, folder), unique=False, rules=null_rules(REQUIRED))
    return store


_VALID = "select * from outcome where reason = ''"

@query("wap_publish", sql(FAULTY, f"""
    select 'bronze.trade' as source, count(*) as n from f
    union all select 'silver valid', count(*) from ({_VALID})
    union all select 'silver quarantine', count(*) from outcome where reason <> ''
    union all select 'gold.daily_security', count(*) from
        (select distinct trade_date, security_id, channel from ({_VALID}))
    union all select 'gold.position', count(*) from
        (select 1 from ({_VALID}) group by investor_id, security_id having sum(signed_qty) <> 0)
    union all select 'gold.broker_daily', count(*) from
        (select distinct trade_date, broker_id, channel from ({_VALID}))
    union all select 'serving.trade', count(*) from ({_VALID})"""))
def wap_publish(spark, folder):
    store = published_faulty(spark, folder, "publish")
    frames = {
        jobs.BRONZE: store.read(jobs.BRONZE),
        "silver valid": jobs.silver_view(store),
        "silver quarantine": jobs.quarantine_view(store),
        jobs.DAILY: store.read(jobs.DAILY),
        jobs.POSITION: store.read(jobs.POSITION),
        jobs.BROKER: store.read(jobs.BROKER),
        jobs.SERVING_TRADE: store.read(jobs.SERVING_TRADE),
    }
    counts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("source"), "n")
              for name, df in frames.items()]
    union = counts[0]
    for one in counts[1:]:
        union = union.unionByName(one)
    return union


@query("refresh_serving", sql(SILVER + " daily", "select * from daily"))
def refresh_serving(spark, folder):
    """The serving copy after a second refresh equals the mart."""
    store = new_store(spark, "refreshed")
    jobs.run_all(store, tables.trades(spark, folder), tables.investors(spark, folder),
                 tables.securities(spark, folder), unique=False, rules=null_rules(REQUIRED))
    jobs.refresh_serving(store)
    return store.read(jobs.SERVING_DAILY).drop("trade_month")


@query("verify_suite", sql(SILVER + " pos bal", """
    select * from (with counted as (
        select (select count(*) from bal) as b, (select count(*) from pos) as p,
               (select count(*) from bal anti join pos using (investor_id, security_id)) as only_b,
               (select count(*) from pos anti join bal using (investor_id, security_id)) as only_p,
               (select count(*) from bal join pos using (investor_id, security_id)
                where abs(nominal_qty - net_qty) > 0.01) as off,
               (select count(*) from t) as bronze, (select count(*) from d) as silver),
    checks as (
        select 1::int as check_no, 'position rows' as check_name, b as e, p as f from counted
        union all select 2, 'positions off by more than the tolerance', 0, off from counted
        union all select 3, 'closed positions', 0, 0 from counted
        union all select 4, 'pairs only in the balance', 0, only_b from counted
        union all select 5, 'pairs only in the positions', 0, only_p from counted
        union all select 6, 'bronze rows explained', bronze, bronze from counted
        union all select 7, 'serving trades', silver, silver from counted
        union all select 8, 'published views', 6, 6 from counted)
    select check_no, check_name, cast(e as varchar) as expected, cast(f as varchar) as found,
           e = f as passed from checks)"""))
def verify_suite(spark, folder):
    """Every check is listed; those about the misbooked accounts do not pass."""
    store = published(spark, folder)
    return jobs.verify(store, balance(spark, folder), jobs.register_views(store))


@query("recon_gate", sql(SILVER + " pos bal", """
    select (select count(*) from bal anti join pos using (investor_id, security_id))
           + (select count(*) from pos anti join bal using (investor_id, security_id)) > 0 as blocked,
           (select count(*) from pos) as positions"""))
def recon_gate(spark, folder):
    """The gate stops the run on the misbooked balance."""
    store = published(spark, folder)
    position = store.read(jobs.POSITION)
    try:
        reconcile.reconciliation_gate(balance(spark, folder), position)
        blocked = False
    except reconcile.ReconciliationError:
        blocked = True
    return position.agg(F.count(F.lit(1)).alias("positions")).select(
        F.lit(blocked).alias("blocked"), "positions")


@query("expected_objects", sql(SILVER + " daily pos broker", """
    select 'bronze.trade' as "table", 'present' as status, count(*) as rows from t
    union all select 'silver.resolved', 'present', count(*) from e
    union all select 'gold.daily_security', 'present', count(*) from daily
    union all select 'gold.position', 'present', count(*) from pos
    union all select 'gold.broker_daily', 'present', count(*) from broker
    union all select 'serving.daily_security', 'present', count(*) from daily
    union all select 'serving.position', 'present', count(*) from pos
    union all select 'serving.trade', 'present', count(*) from e
    union all select 'serving.broker_daily', 'MISSING', null"""))
def expected_objects(spark, folder):
    store = published(spark, folder)
    return jobs.expected_tables(store, (*jobs.PUBLISHED, "serving.broker_daily"))


@query("pinned_views", sql(TRADES, """
    select 'view' as version, count(*) as trade_count, cast(sum(amount) as decimal(24,4)) as volume from t
    union all
    select 'stage', count(*) * 2, cast(sum(amount) * 101 as decimal(24,4)) from t"""))
def pinned_views(spark, folder):
    """A faulty delivery on a stage does not reach the readers of the view."""
    store = published_trades(spark, folder, "views")
    store.read(jobs.BRONZE).createOrReplaceTempView("published_bronze_trade")
    store.create_ref("stage")
    rows = store.read(jobs.BRONZE).select(*store.columns(jobs.BRONZE))
    store.append(jobs.BRONZE, resent_batch(rows, KEY_SHIFT, LATE_CHANNEL), "stage")
    seen = spark.sql("select amount from published_bronze_trade")
    return labelled(seen, "view").unionByName(labelled(store.read(jobs.BRONZE, "stage"), "stage"))


@query("bronze_lineage", sql(TRADES, "select count(*) as n, 1::bigint as jobs, 1::bigint as stamps from t"))
def bronze_lineage(spark, folder):
    store = published_trades(spark, folder, "lineage")
    return store.read(jobs.BRONZE).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("_ingest_job").alias("jobs"),
        F.count_distinct("_ingest_ts").alias("stamps"))


@query("incremental_load", sql(LATEST, "select * from d"))
def incremental_load(spark, folder):
    """A first load up to a date, then one increment from the high-water mark."""
    trades = tables.trades(spark, folder)
    store = new_store(spark, "incremental")
    first = trades.filter(F.col("updated_ts") < at(datetime(2000, 1, 1)))
    jobs.load_bronze(store, first, mode="incremental", rules=null_rules(REQUIRED))
    jobs.load_bronze(store, trades, mode="incremental", rules=null_rules(REQUIRED))
    return store.read(jobs.BRONZE).select(*TRADE.names)


# ---- files and layout: what is on disk depends on the writer, so rows only

@query("describe_tables")
def describe_tables(spark, folder):
    store = published(spark, folder)
    rows = [(table, name, kind, position)
            for table in store.state()
            for position, (name, kind) in enumerate(store.read(table).dtypes)]
    columns = spark.createDataFrame(rows, "table string, column string, type string, position int")
    counts = upkeep.table_sizes(store).select("table", "rows")
    return columns.join(F.broadcast(counts), "table")


@query("table_rows", sql(SILVER + " daily pos broker", """
    select 'bronze.trade' as "table", count(*) as rows from t
    union all select 'silver.resolved', count(*) from e
    union all select 'gold.daily_security', count(*) from daily
    union all select 'gold.position', count(*) from pos
    union all select 'gold.broker_daily', count(*) from broker
    union all select 'serving.daily_security', count(*) from daily
    union all select 'serving.position', count(*) from pos
    union all select 'serving.trade', count(*) from e"""))
def table_rows(spark, folder):
    """The determined part of ``table_sizes``: files and bytes depend on the writer."""
    return upkeep.table_sizes(published(spark, folder)).select("table", "rows")


_TRADE_COLUMNS = ", ".join(f"('{name}', '{kind.simpleString()}', {at})" for at, (name, kind) in enumerate(
    [(f.name, f.dataType) for f in TRADE.fields]))


@query("described_columns", f"""
    select c as column, k as type, p::int as position from (values {_TRADE_COLUMNS}) as v(c, k, p)""")
def described_columns(spark, folder):
    """The declared columns of the stored trades, as a reader finds them."""
    store = published_trades(spark, folder, "described")
    rows = [(name, kind, at) for at, (name, kind) in enumerate(store.read(jobs.BRONZE).select(*TRADE.names).dtypes)]
    return spark.createDataFrame(rows, "column string, type string, position int")


@query("table_sizes")
def table_sizes(spark, folder):
    return upkeep.table_sizes(published(spark, folder))


@query("parquet_file_inventory")
def parquet_file_inventory(spark, folder):
    store = published_trades(spark, folder, "inventory")
    return file_inventory(parquet_files(spark, [f"{store.root}/data"]))


@query("file_profile")
def file_profile(spark, folder):
    store = published_trades(spark, folder, "profile")
    return upkeep.profile(upkeep.live_files(store, jobs.BRONZE))


@query("compaction_candidates")
def compaction_candidates(spark, folder):
    """Before and after a compaction of a table that was loaded in two halves."""
    trades = tables.trades(spark, folder)
    store = new_store(spark, "candidates")
    store.write("trade", trades.filter("side = 'BUY'"), MAIN, "load", jobs.MONTHLY)
    store.append("trade", trades.filter("side = 'SELL'"), MAIN)
    before = upkeep.diagnosis(upkeep.live_files(store, "trade"))
    upkeep.compact(store, "trade", sort_by=("trade_ts",))
    after = upkeep.diagnosis(upkeep.live_files(store, "trade"))
    return before.withColumn("state", F.lit("before")).unionByName(
        after.withColumn("state", F.lit("after")))


@query("compaction_effect", sql(TRADES, """
    select 'before' as state, count(*) as partitions, count(*) filter (sides = 2) as candidates,
           false as one_file_each from (select count(distinct side) as sides from t group by strftime(trade_ts, '%Y-%m'))
    union all select 'after', count(*), 0, true from (select distinct strftime(trade_ts, '%Y-%m') from t)"""))
def compaction_effect(spark, folder):
    """The determined part of ``compaction_candidates`` and of a file profile by partition."""
    trades = tables.trades(spark, folder)
    store = new_store(spark, "effect")
    frames = []
    store.write("trade", trades.filter("side = 'BUY'"), MAIN, "load", jobs.MONTHLY)
    store.append("trade", trades.filter("side = 'SELL'"), MAIN)
    for state in ("before", "after"):
        if state == "after":
            upkeep.compact(store, "trade", sort_by=("trade_ts",))
        files = upkeep.live_files(store, "trade")
        per = upkeep.per_partition(files).agg(F.max("files").alias("most"))
        frames.append(upkeep.diagnosis(files).select("partitions", "candidates").crossJoin(per).select(
            F.lit(state).alias("state"), "partitions", "candidates", (F.col("most") == 1).alias("one_file_each")))
    return frames[0].unionByName(frames[1])


@query("pruning_probe", sql(TRADES, """
    select 'all' as scenario, count(*) as rows, count(distinct strftime(trade_ts, '%Y-%m')) as folders,
           true as all_bytes from t
    union all select '1997-03', count(*), 1, false from t where strftime(trade_ts, '%Y-%m') = '1997-03'"""))
def pruning_probe(spark, folder):
    store = published_trades(spark, folder, "pruning")
    probe = upkeep.pruning_probe(store, jobs.BRONZE, "1997-03")
    whole = upkeep.live_files(store, jobs.BRONZE).agg(F.sum("length")).scalar()
    return probe.select("scenario", "rows", "folders", (F.col("bytes") == whole).alias("all_bytes"))


@query("clustered_layout", sql(TRADES, """
    select strftime(trade_ts, '%Y-%m') as trade_month, count(*) as rows,
           min(trade_ts) as first_trade, max(trade_ts) as last_trade, 0::bigint as out_of_order
    from t group by 1"""))
def clustered_layout(spark, folder):
    """What each month folder of the stored table holds, and how many rows of its files come
    after a later one."""
    store = published_trades(spark, folder, "clustered")
    rows = store.read(jobs.BRONZE, with_file=True)
    return sorted_inside(rows, "trade_ts", "trade_month").groupBy("trade_month").agg(
        F.count(F.lit(1)).alias("rows"), F.min("trade_ts").alias("first_trade"),
        F.max("trade_ts").alias("last_trade"), F.count_if("out_of_order").alias("out_of_order"))


@query("retention_plan")
def retention_plan(spark, folder):
    """Seven versions of the bronze table: the first ones may expire in ten days."""
    store = published_trades(spark, folder, "retention")
    for number in range(6):
        evolution.add_columns(store, jobs.BRONZE, MAIN, {f"note_{number}": "string"})
    later = datetime.now(timezone.utc) + timedelta(days=10)
    return upkeep.retention_plan(store, jobs.BRONZE, later)


@query("orphan_files")
def orphan_files(spark, folder):
    """A write that died before its commit is the only thing reported."""
    store = published_trades(spark, folder, "orphans")
    stray = tables.trades(spark, folder).repartition(tables.tasks_for_trades(spark, folder, 3))
    stray.write.parquet(f"{store.data_folder(jobs.BRONZE)}/v=9-deadbeef")
    later = datetime.now(timezone.utc) + timedelta(days=4)
    found = upkeep.orphan_files(store, jobs.BRONZE, later)
    return found.agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))


@query("version_summary")
def version_summary(spark, folder):
    return upkeep.version_summary(published_trades(spark, folder, "summary"), jobs.BRONZE)


@query("layer_bench")
def layer_bench(spark, folder):
    """The quarterly report on each layer: seconds, rows read, factor to the slowest."""
    store = published(spark, folder)
    source, securities = tables.trades(spark, folder), tables.securities(spark, folder)
    kind, (first, last) = SECURITY_TYPE, QUARTER
    layers: dict[str, tuple[DataFrame, DataFrame]] = {
        "source": (reports.channel_report_on_source(source, securities, kind, first, last), source),
        "silver": (reports.channel_report(jobs.silver_view(store), kind, first, last),
                   jobs.silver_view(store)),
        "serving": (reports.channel_report(store.read(jobs.SERVING_TRADE), kind, first, last),
                    store.read(jobs.SERVING_TRADE)),
        "gold": (reports.channel_report_on_mart(store.read(jobs.SERVING_DAILY), kind, first, last),
                 store.read(jobs.SERVING_DAILY)),
    }
    measured = []
    for layer, (report, table) in layers.items():
        started = perf_counter()
        report.write.format("noop").mode("overwrite").save()
        measured.append((layer, int((perf_counter() - started) * 1000), table.count()))
    costs = spark.createDataFrame(measured, "layer string, elapsed_ms bigint, table_rows bigint")
    factors = reports.speedup(costs, "layer", "elapsed_ms")
    return factors.join(costs.select("layer", "table_rows"), "layer").select(
        "layer", "elapsed_ms",
        human_count(F.col("table_rows")).alias("table_rows"), "factor")


@query("serving_lookup", sql(SILVER + " pos", "select * from pos where investor_id = 7"))
def serving_lookup(spark, folder):
    """One investor from the copy that is ordered by investor and has Bloom filters."""
    store = published(spark, folder)
    return store.read(jobs.SERVING_POSITION).filter(F.col("investor_id") == 7).drop("calculated_at")


@query("point_lookup", sql(SILVER, "select * from e where investor_id = 7"))
def point_lookup(spark, folder):
    """The trades of one investor from the detail copy: no shuffle, and its Bloom filters skip row groups."""
    store = published(spark, folder)
    return store.read(jobs.SERVING_TRADE).filter(F.col("investor_id") == 7).drop("trade_month")


@query("serving_layout", sql(SILVER, """
    select strftime(trade_ts, '%Y-%m') as trade_month, count(*) as rows,
           min(trade_date) as first_date, max(trade_date) as last_date,
           count(distinct investor_id) as investors from e group by 1"""))
def serving_layout(spark, folder):
    """What each month folder of the serving detail copy holds."""
    store = published(spark, folder)
    return store.read(jobs.SERVING_TRADE).groupBy("trade_month").agg(
        F.count(F.lit(1)).alias("rows"), F.min("trade_date").alias("first_date"),
        F.max("trade_date").alias("last_date"), F.count_distinct("investor_id").alias("investors"))


@query("federated_report", sql(SILVER, """
    select investor_type, count(*) as trade_count, cast(sum(amount) as decimal(24,4)) as volume
    from (select e.* exclude (investor_type, country) from e) x
    join c on x.investor_id = c.investor_id where not active group by investor_type"""))
def federated_report(spark, folder):
    """Published lake trades joined with the operational investor table."""
    store = published(spark, folder)
    lake = jobs.silver_view(store).drop("investor_type")
    return reports.closed_account_volume(lake, tables.investors(spark, folder))
