"""Timings of the headline jobs and reports; prints one JSON line.

Builds run twice and the second, warm, run counts. Reports are the median of five
runs after one warm-up. Nothing is cached between runs: every run scans its files.
"""

from __future__ import annotations

import json
import os
import sys
from collections.abc import Callable
from datetime import datetime
from statistics import median
from time import perf_counter

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from depotlake.model import REQUIRED, TRADE  # noqa: E402
from depotlake.operators import reconcile, reports, upkeep  # noqa: E402
from depotlake.operators.joins import broadcast_if_small  # noqa: E402
from depotlake.operators.dedup import latest_per_key  # noqa: E402
from depotlake.operators.quality import null_rules  # noqa: E402
from depotlake.operators.upsert import update_all, upsert_into  # noqa: E402
from depotlake.plans import jobs  # noqa: E402
from depotlake.plans.recon_queries import balance  # noqa: E402
from depotlake.plans.report_queries import QUARTER, SECURITY_TYPE  # noqa: E402
from depotlake.session import build_session, workspace  # noqa: E402
from depotlake.sources import tables  # noqa: E402
from depotlake.sources.store import MAIN, Store  # noqa: E402

REPORT_RUNS = 5


def clock(action: Callable[[], object]) -> float:
    started = perf_counter()
    action()
    return perf_counter() - started


def run_report(df: Callable[[], DataFrame]) -> float:
    """Median seconds from planning to the last row, with every row fetched."""
    df().collect()
    return median(clock(lambda: df().collect()) for _ in range(REPORT_RUNS))


def build(spark: SparkSession, folder: str) -> tuple[Store, dict[str, float]]:
    store = Store(spark, workspace(spark, "bench"))
    investors, securities = tables.investors(spark, folder), tables.securities(spark, folder)
    steps = {
        "build_bronze": lambda: jobs.load_bronze(store, tables.trades(spark, folder), unique=False,
                                                 rules=null_rules(REQUIRED)),
        "build_silver": lambda: jobs.build_silver(store, investors, securities),
        "build_marts": lambda: jobs.build_gold(store),
        "build_serving": lambda: jobs.refresh_serving(store),
    }
    return store, {name: clock(step) for name, step in steps.items()}


def run_reports(spark: SparkSession, folder: str, store: Store) -> dict[str, float]:
    kind, (first, last) = SECURITY_TYPE, QUARTER
    source, securities = tables.trades(spark, folder), tables.securities(spark, folder)
    month = datetime(1997, 3, 1), datetime(1997, 4, 1)
    silver, detail = jobs.silver_view(store), store.read(jobs.SERVING_TRADE)
    daily, position = store.read(jobs.SERVING_DAILY), store.read(jobs.SERVING_POSITION)
    return {name: run_report(df) for name, df in {
        "q_source": lambda: reports.channel_report_on_source(source, securities, kind, first, last),
        "q_detail": lambda: reports.channel_report(silver, kind, first, last),
        "q_serving": lambda: reports.channel_report(detail, kind, first, last),
        "q_mart": lambda: reports.channel_report_on_mart(daily, kind, first, last),
        "top10_mart": lambda: reports.top_on_mart(daily, first, last),
        "point_lookup_lake": lambda: silver.filter(F.col("investor_id") == 7),
        "point_lookup_serving": lambda: position.filter(F.col("investor_id") == 7),
        "month_full": lambda: reports.totals(silver),
        "month_pruned": lambda: reports.totals(reports.trades_between(silver, *month)),
        "channel_trend": lambda: reports.monthly_channel_trend(silver),
        "reconcile": lambda: reconcile.full_comparison(balance(spark, folder),
                                                       store.read(jobs.POSITION)),
    }.items()}


def run_changes(spark: SparkSession, folder: str) -> dict[str, float]:
    """Upserts of about 1% of the trades, a rollback and a compaction."""
    store = Store(spark, workspace(spark, "bench-changes"))
    trades = latest_per_key(tables.trades(spark, folder))
    store.write("trade", trades, MAIN, layout=jobs.MONTHLY, sort_by=("trade_ts",))
    newer = F.col("updated_ts") + F.make_dt_interval(days=F.lit(1))

    def changed(condition: str) -> DataFrame:
        rows = store.read("trade").filter(condition).select(*TRADE.names)
        return update_all(rows, {"qty": F.col("qty") * 2, "updated_ts": newer})

    small = tables.table(spark, folder, "part").filter("p_size = 1").select("p_partkey")
    scattered = changed("true").join(broadcast_if_small(small), F.col("security_id") == F.col("p_partkey"),
                                     "left_semi")
    out = {
        "upsert_1pct_one_month": clock(lambda: upsert_into(
            store, "trade", changed("trade_month = '1998-06'"), MAIN, sort_by=("trade_ts",))),
        "upsert_2pct_all_months": clock(lambda: upsert_into(
            store, "trade", scattered, MAIN, sort_by=("trade_ts",))),
    }
    out["rollback"] = clock(lambda: store.rollback("trade", 1))
    rows = store.read("trade").select(*TRADE.names)
    for side in ("BUY", "SELL"):
        store.append("halves", rows.filter(F.col("side") == side), MAIN, layout=jobs.MONTHLY)
    out["compact"] = clock(lambda: upkeep.compact(store, "halves", sort_by=("trade_ts",)))
    return out


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    spark = build_session("bench", f"local[{cpus}]", conf={
        "spark.driver.memory": "12g",
        "spark.sql.shuffle.partitions": cpus,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    _, cold = build(spark, folder)
    store, seconds = build(spark, folder)
    seconds |= run_reports(spark, folder, store)
    seconds |= run_changes(spark, folder)
    rows = store.read(jobs.BRONZE).count()
    builds = [name for name in seconds if name.startswith("build_")]
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": {name: round(value, 4) for name, value in seconds.items()},
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus), "trades": rows,
        "rows_per_second": {name: round(rows / seconds[name]) for name in builds},
        "cold": {name: round(value, 3) for name, value in cold.items()},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
