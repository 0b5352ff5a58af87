"""Run one job, or the whole chain, over a folder of source tables::

    spark-submit run_job.py bronze --tables FOLDER --store ROOT --full
    spark-submit run_job.py bronze --tables FOLDER --store ROOT --since 2001-01-01T00:00:00
    spark-submit run_job.py silver --tables FOLDER --store ROOT --no-publish
    spark-submit run_job.py all --tables FOLDER --store ROOT --partitions 2000

``all`` always ends with the reconciliation gate and the suite of checks.
A failed audit, gate or check ends the process with status 1; what it would have published stays on its stage.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import SparkSession

from depotlake.model import REQUIRED
from depotlake.operators import marts
from depotlake.operators.dedup import latest_per_key
from depotlake.operators.quality import QualityError, null_rules
from depotlake.operators.reconcile import ReconciliationError
from depotlake.plans import jobs
from depotlake.session import build_session
from depotlake.sources import tables
from depotlake.sources.store import ConflictError, Store


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(description="Jobs between the layers.")
    out.add_argument("job", choices=("bronze", "silver", "gold", "serving", "all"))
    out.add_argument("--tables", required=True, help="folder of the source tables")
    out.add_argument("--store", required=True, help="root of the versioned tables")
    mode = out.add_mutually_exclusive_group()
    mode.add_argument("--full", action="store_true", help="replace bronze instead of adding what changed")
    mode.add_argument("--since", type=datetime.fromisoformat, help="start of the increment; else the newest change loaded")
    out.add_argument("--no-publish", action="store_true", help="leave the audited stage to a later publish")
    out.add_argument("--partitions", type=int, help="initial number of reducers")
    out.add_argument("--balance", help="Parquet of the other party's balance: investor_id, security_id, nominal_qty; "
                                       "else the gate takes the balance straight from the source's trades")
    return out


def run(spark: SparkSession, options: argparse.Namespace) -> None:
    store, publish = Store(spark, options.store), not options.no_publish
    source = tables.trades(spark, options.tables)
    investors, securities = tables.investors(spark, options.tables), tables.securities(spark, options.tables)
    rules = null_rules(REQUIRED)
    if options.partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(options.partitions))
    if options.job == "bronze":
        jobs.load_bronze(store, source, "full" if options.full else "incremental", options.since,
                         unique=False, rules=rules, publish=publish)
    elif options.job == "silver":
        jobs.build_silver(store, investors, securities, publish)
    elif options.job == "gold":
        jobs.build_gold(store, publish=publish)
    elif options.job == "serving":
        jobs.refresh_serving(store, publish)
    else:
        balance = spark.read.parquet(options.balance) if options.balance else marts.eod_balance(latest_per_key(source))
        jobs.run_all(store, source, investors, securities, unique=False, rules=rules, balance=balance)


def main(arguments: Sequence[str] | None = None) -> int:
    options = parser().parse_args(arguments)
    try:
        run(build_session(f"depotlake {options.job}"), options)
    except (QualityError, ReconciliationError, ConflictError) as error:
        print(f"{options.job} failed: {error}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
