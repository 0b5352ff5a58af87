"""The jobs between the layers. Each one stages, audits, and only then publishes."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotlake.functions.expressions import by_bucket, by_month, month_of
from depotlake.model import BROKER_KEYS, DAILY_KEYS, PAIR_KEY, QUARANTINE, SILVER, TRADE, TRADE_KEY
from depotlake.operators import marts, quality, reconcile, silver
from depotlake.operators.upsert import upsert_into
from depotlake.session import shuffles_removed, workspace
from depotlake.sources.ingest import changed_since, high_water_mark, typed, with_lineage
from depotlake.sources.store import MAIN, Store

BRONZE, RESOLVED = "bronze.trade", "silver.resolved"
DAILY, POSITION, BROKER = "gold.daily_security", "gold.position", "gold.broker_daily"
SERVING_DAILY, SERVING_POSITION, SERVING_TRADE = (
    "serving.daily_security", "serving.position", "serving.trade")
PUBLISHED = (BRONZE, RESOLVED, DAILY, POSITION, BROKER,
             SERVING_DAILY, SERVING_POSITION, SERVING_TRADE)

MONTHLY = {"trade_month": by_month("trade_ts")}
DAILY_MONTHLY = {"trade_month": by_month("trade_date")}

# Notes in the manifests of marts and copies: the version of the resolved trades they were made from, and whether
# every trade lies in the folder of the month of its trade date, so that a month of dates is a month of folders.
SOURCE, ALIGNED = RESOLVED, "dates follow folders"

# One layout per table, the same at every size. Layout columns are derived: the real ones
# stay in the files, as a folder name can tell neither '' nor NULL from the other.
RESOLVED_LAYOUT = {"outcome_part": "outcome", **MONTHLY}
POSITION_BUCKETS = 16


def position_layout(buckets: int = POSITION_BUCKETS) -> dict[str, str]:
    """By investor, in a declared number of buckets."""
    return {"investor_bucket": by_bucket("investor_id", buckets)}


def keyed_layout(buckets: int, key: str = TRADE_KEY) -> dict[str, str]:
    """By month, and within a month in a declared number of buckets of the key, for tables that take upserts."""
    return {"key_bucket": by_bucket(key, buckets), **MONTHLY}


Audit = Callable[[str], None]


def stamp() -> str:
    return datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S_%f")


def write_audit_publish(store: Store, name: str, write: Callable[[str], None], audit: Audit,
                        publish: bool = True) -> str:
    """Write on a new ref, audit there, publish when the audit passes.

    A published ref is dropped. When the audit raises, or with ``publish=False``, it
    stays for inspection and the readers of main see nothing of it.
    """
    ref = f"{name}_{stamp()}"
    store.create_ref(ref)
    write(ref)
    audit(ref)
    if publish:
        store.publish(ref)
        store.drop_ref(ref)
    return ref


def audit_bronze(trades: DataFrame, unique: bool = True,
                 rules: dict[str, Column] | None = None) -> None:
    """Blocking rules of the ingest. A feed that sends versions of a trade again
    is not unique by nature; the silver job removes those."""
    quality.require_clean(quality.quality_report(trades, (TRADE_KEY,) if unique else None, rules), BRONZE)


def touched(store: Store, table: str, ref: str) -> DataFrame | None:
    """The rows of the parts that ``ref`` shows and main does not; None where there are none."""
    state = store.state()
    known = {p["dir"] for p in store.manifest(table, state[table])["parts"]} if table in state else set()
    new = [p["dir"] for p in store.manifest(table, store.state(ref)[table])["parts"] if p["dir"] not in known]
    return store.read(table, ref, parts=new) if new or not known else None


def load_bronze(store: Store, source: DataFrame, mode: str = "full",
                since: datetime | None = None, unique: bool = True,
                rules: dict[str, Column] | None = None, publish: bool = True) -> str:
    """Load trades fully, or upsert those changed since ``since``.

    Without ``since`` an increment starts at the newest change already loaded.
    A full load replaces the table, so months the source no longer has go too.
    """
    if mode not in ("full", "incremental"):
        raise ValueError(f"unknown mode {mode}")
    now = datetime.now(timezone.utc)
    rows = typed(source, TRADE)

    def write(ref: str) -> None:
        if mode == "full":
            store.write(BRONZE, with_lineage(rows, now, ref), ref, "full load", MONTHLY, ("trade_ts",))
            return
        loaded = store.read(BRONZE, ref) if BRONZE in store.state(ref) else None
        start = since or (high_water_mark(loaded) if loaded is not None else None)
        changes = rows if start is None else changed_since(rows, start)
        upsert_into(store, BRONZE, with_lineage(changes, now, ref), ref, layout=MONTHLY,
                    sort_by=("trade_ts",))

    def audit(ref: str) -> None:
        # An increment is audited where it wrote: the other parts were, when they came.
        rows = touched(store, BRONZE, ref)
        if rows is not None:
            audit_bronze(rows, unique, rules)

    return write_audit_publish(store, "etl_bronze", write, audit, publish)


def with_outcome(store: Store, outcome: str, ref: str = MAIN) -> DataFrame:
    """Resolved trades of one outcome; folders of the other are not read."""
    rows = store.read(RESOLVED, ref)
    return rows.filter((F.col("outcome") == outcome) & (F.col("outcome_part") == outcome))


def silver_view(store: Store, ref: str = MAIN) -> DataFrame:
    """Valid trades, with the month for readers that prune by it."""
    return with_outcome(store, silver.VALID, ref).select(*SILVER.names, "trade_month")


def quarantine_view(store: Store, ref: str = MAIN) -> DataFrame:
    """Rejected trades, why, and when the run that rejected them began."""
    return with_outcome(store, silver.QUARANTINED, ref).select(*QUARANTINE.names, silver.QUARANTINED_AT)


def audit_silver(store: Store, ref: str) -> None:
    """Every bronze key is in silver or in the quarantine, once."""
    row = reconcile.row_accounting(store.read(BRONZE, ref), store.read(RESOLVED, ref)).first()
    if not row["balanced"]:
        raise quality.QualityError(f"{RESOLVED}: rows do not add up: {row.asDict()}")


def build_silver(store: Store, investors: DataFrame, securities: DataFrame,
                 publish: bool = True, now: datetime | None = None) -> str:
    """One lineage, one table: the outcome column separates valid trades from the
    quarantine, so dedup and joins run once and nothing is cached. Rejected rows are
    stamped with ``now``, a value of the driver, so a task that runs again writes the same.
    Resolved rows are written once before they are laid out, so that the shuffle files of dedup
    and joins are gone when those of the layout come."""
    now = now or datetime.now(timezone.utc)

    def write(ref: str) -> None:
        bronze = store.read(BRONZE, ref).select(*TRADE.names)
        resolved = silver.stamped(silver.resolve(bronze, investors, securities), now)
        path = workspace(store.spark, "resolved")
        with shuffles_removed(store.spark):
            resolved.write.option("compression", "zstd").parquet(path)
        store.write(RESOLVED, store.spark.read.schema(resolved.schema).parquet(path), ref, "full refresh",
                    RESOLVED_LAYOUT, ("security_type", "trade_ts", "security_id"))
        store.files.remove(path)

    return write_audit_publish(store, "etl_silver", write,
                               lambda ref: audit_silver(store, ref), publish)


def audit_gold(store: Store, ref: str) -> None:
    """Marts hold each key once, count every valid trade, and no closed position.
    One query, so that the marts are checked side by side."""
    none = F.lit(0).cast("bigint")
    valid = with_outcome(store, silver.VALID, ref)
    found = valid.agg(F.count(F.lit(1)).alias("trades")).select(
        F.lit(RESOLVED).alias("table"), none.alias("repeated"), none.alias("closed"), "trades")
    for table, keys in ((DAILY, DAILY_KEYS), (POSITION, PAIR_KEY), (BROKER, BROKER_KEYS)):
        closed = F.col("net_qty") == 0 if table == POSITION else F.lit(False)
        mart = store.read(table, ref).groupBy(*keys).agg(
            F.count(F.lit(1)).alias("n"), F.sum("trade_count").alias("trades"),
            F.count_if(closed).alias("closed")).agg(
            F.count_if(F.col("n") > 1).alias("repeated"),
            F.coalesce(F.sum("closed"), none).alias("closed"),
            F.coalesce(F.sum("trades"), none).alias("trades"))
        found = found.unionByName(mart.withColumn("table", F.lit(table)))
    rows = {r["table"]: r for r in found.collect()}
    for table in (DAILY, POSITION, BROKER):
        row = rows[table]
        if row["repeated"] or row["closed"]:
            raise quality.QualityError(f"{table}: {row['repeated']} repeated keys, "
                                       f"{row['closed']} closed positions")
        if table != POSITION and row["trades"] != rows[RESOLVED]["trades"]:
            raise quality.QualityError(f"{table} counts {row['trades']} of "
                                       f"{rows[RESOLVED]['trades']} trades")


def build_gold(store: Store, calculated_at: datetime | None = None, publish: bool = True) -> str:
    at = F.lit(calculated_at or datetime.now(timezone.utc))

    def write(ref: str) -> None:
        trades = silver_view(store, ref)
        notes = {SOURCE: store.state(ref)[RESOLVED]}
        held = marts.positions(trades, *position_layout().values())
        store.write_together(ref, [
            {"table": DAILY, "df": marts.daily_security(trades), "operation": "full refresh",
             "layout": DAILY_MONTHLY, "notes": notes, "grouped": True,
             "sort_by": ("trade_date", "security_type", "security_id", "channel")},
            {"table": POSITION, "df": held.withColumn("calculated_at", at), "operation": "full refresh",
             "layout": position_layout(), "notes": notes, "grouped": True,
             "sort_by": ("investor_id", "security_id")},
            {"table": BROKER, "df": marts.broker_daily(trades), "operation": "full refresh",
             "layout": DAILY_MONTHLY, "grouped": True, "sort_by": ("trade_date", "broker_id")},
        ])

    return write_audit_publish(store, "etl_gold", write, lambda ref: audit_gold(store, ref), publish)


def required(column: str, kind: str) -> Column:
    """The column, failing the job on the first NULL in it."""
    missing = F.raise_error(F.lit(f"{column} is null")).cast(kind)
    return F.when(F.col(column).isNotNull(), F.col(column)).otherwise(missing).alias(column)


def misplaced(trades: DataFrame) -> int:
    """Trades outside the folder of the month of their trade date."""
    return trades.agg(F.count_if(~month_of("trade_date").eqNullSafe(F.col("trade_month")))).first()[0]


def refresh_serving(store: Store, publish: bool = True) -> str:
    """Copies ordered by access path: by date, by investor, and detail rows with
    Bloom filters for the columns they are not ordered by. Each file covers a
    range of its own, so a lookup opens the files of its range only."""
    def write(ref: str) -> None:
        daily = store.read(DAILY, ref).select(*store.columns(DAILY, ref))
        # Only the average price may be NULL: a group without quantity has none.
        strict = daily.select(*(F.col(c) if c == "vwap" else required(c, t)
                                for c, t in daily.dtypes))
        position = store.read(POSITION, ref).select(*store.columns(POSITION, ref))
        detail = with_outcome(store, silver.VALID, ref)
        aligned = {ALIGNED: int(misplaced(detail) == 0)}
        store.write_together(ref, [
            # The mart has the layout and order of its copy: its files lie by month as they are.
            {"table": SERVING_DAILY, "df": strict, "operation": "refresh", "dealt": True,
             "layout": DAILY_MONTHLY, "notes": {SOURCE: store.applied(DAILY, ref, SOURCE), **aligned},
             "sort_by": ("trade_date", "security_type", "security_id", "channel")},
            {"table": SERVING_POSITION, "df": position, "operation": "refresh", "layout": {},
             "notes": {SOURCE: store.applied(POSITION, ref, SOURCE)}, "by_range": True, "sort_by": ("investor_id", "security_type", "security_id"),
             "bloom_on": ("investor_id",)},
            {"table": SERVING_TRADE, "df": detail.select(*SILVER.names), "operation": "refresh",
             "layout": MONTHLY, "by_range": True, "notes": {SOURCE: store.state(ref)[RESOLVED]},
             "sort_by": ("trade_date", "security_type", "security_id", "trade_id"),
             "bloom_on": ("investor_id", "broker_id")},
        ])

    def audit(ref: str) -> None:
        sources = {SERVING_DAILY: store.read(DAILY, ref), SERVING_POSITION: store.read(POSITION, ref),
                   SERVING_TRADE: silver_view(store, ref)}
        counts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(copy).alias("copy"), "n")
                  for copy, df in sources.items()]
        for row in reduce(DataFrame.unionByName, counts).collect():
            have = store.rows_written(row["copy"], ref)
            if have != row["n"]:
                raise quality.QualityError(f"{row['copy']} has {have} rows instead of {row['n']}")

    return write_audit_publish(store, "etl_serving", write, audit, publish)


def register_views(store: Store, ref: str = MAIN) -> list[str]:
    """Temp views pinned to the versions ``ref`` shows now; later writes on other
    refs do not reach their readers. Layout columns are hidden, except the month of silver
    trades, which their readers prune by."""
    def plain(table: str) -> DataFrame:
        return store.read(table, ref).select(*store.columns(table, ref))

    views = {"bronze_trade": lambda: plain(BRONZE),
             "silver_trade": lambda: silver_view(store, ref),
             "silver_quarantine": lambda: quarantine_view(store, ref),
             "gold_daily_security": lambda: plain(DAILY),
             "gold_position": lambda: plain(POSITION),
             "gold_broker_daily": lambda: plain(BROKER)}
    for name, read in views.items():
        read().createOrReplaceTempView(name)
    return list(views)


def verify(store: Store, balance: DataFrame, views: Sequence[str] = ()) -> DataFrame:
    """Every invariant as a row: number, name, expected, found, passed."""
    compared = reconcile.full_comparison(balance, store.read(POSITION)).first()
    zero = store.read(POSITION).filter("net_qty = 0").count()
    rows = reconcile.row_accounting(store.read(BRONZE), store.read(RESOLVED)).first()
    # Key by key: a lost and a repeated row do not make up for each other.
    explained = rows["silver"] + rows["quarantine"] + rows["duplicates"] - rows["lost"] - rows["repeated"]
    existing = {t.name for t in store.spark.catalog.listTables()}
    check = reconcile.check
    checks = [
        check(1, "position rows", compared["balances"], compared["positions"]),
        check(2, "positions off by more than the tolerance", 0, compared["mismatched"]),
        check(3, "closed positions", 0, zero),
        check(4, "pairs only in the balance", 0, compared["only_balance"]),
        check(5, "pairs only in the positions", 0, compared["only_position"]),
        check(6, "bronze rows explained", rows["bronze"], explained),
        check(7, "serving trades", rows["silver"], store.read(SERVING_TRADE).count()),
        check(8, "published views", len(views), len(existing & set(views))),
    ]
    return store.spark.createDataFrame(checks, reconcile.CHECK_SCHEMA)


def expected_tables(store: Store, expected: Sequence[str] = PUBLISHED) -> DataFrame:
    """Which of the expected tables main shows, and with how many rows."""
    spark = store.spark
    wanted = spark.createDataFrame([(t,) for t in expected], "table string")
    counts = [(t, store.read(t).count()) for t in store.state()]
    actual = spark.createDataFrame(counts, "table string, rows bigint")
    status = F.when(F.col("rows").isNull(), "MISSING").otherwise("present")
    return wanted.join(F.broadcast(actual), "table", "left").select("table", status.alias("status"),
                                                                    "rows")


def run_all(store: Store, source: DataFrame, investors: DataFrame, securities: DataFrame,
            unique: bool = True, rules: dict[str, Column] | None = None,
            balance: DataFrame | None = None) -> None:
    """Bronze, silver, gold and the serving copies; the first failure stops the run.

    With the depository's ``balance`` the run ends with the gate: positions must
    reconcile, and every check of the suite must pass.
    """
    load_bronze(store, source, unique=unique, rules=rules)
    build_silver(store, investors, securities)
    build_gold(store)
    refresh_serving(store)
    if balance is not None:
        reconcile.reconciliation_gate(balance, store.read(POSITION))
        reconcile.require_passed(verify(store, balance, register_views(store)))
