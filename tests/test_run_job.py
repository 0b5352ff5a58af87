from __future__ import annotations

import pytest
import run_job
from depotlake.operators import marts
from depotlake.plans import jobs
from depotlake.sources.store import Store
from depotlake.session import workspace
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"


def test_jobs_one_by_one_and_the_gate(spark):
    root = workspace(spark, "run-job")
    store, where = Store(spark, root), ["--tables", FOLDER, "--store", root]
    assert run_job.main(["bronze", *where, "--full"]) == 0
    loaded = store.read(jobs.BRONZE).count()
    assert run_job.main(["bronze", *where, "--since", "2030-01-01T00:00:00"]) == 0
    assert store.read(jobs.BRONZE).count() == loaded
    assert run_job.main(["silver", *where, "--no-publish"]) == 0
    assert jobs.RESOLVED not in store.state()
    assert run_job.main(["silver", *where]) == 0
    balance = marts.eod_balance(jobs.silver_view(store))
    wrong = f"{root}-balance"
    balance.withColumn("nominal_qty", (F.col("nominal_qty") + 1).cast("decimal(24,4)")).write.parquet(wrong)
    assert run_job.main(["all", *where, "--balance", wrong]) == 1
    assert run_job.main(["all", *where]) == 0


def test_the_gate_cannot_be_left_out(spark, monkeypatch):
    """Trades that the rules reject are missing from the positions; the source's own balance shows it."""
    faulty = run_job.tables.faulty_trades(spark, FOLDER)
    monkeypatch.setattr(run_job.tables, "trades", lambda *_: faulty)
    monkeypatch.setattr(run_job, "REQUIRED", ("trade_id", "investor_id"))
    root = workspace(spark, "run-gate")
    assert run_job.main(["all", "--tables", FOLDER, "--store", root]) == 1
    assert jobs.POSITION in Store(spark, root).state()


def test_full_and_since_exclude_each_other():
    with pytest.raises(SystemExit):
        run_job.parser().parse_args(["bronze", "--tables", "a", "--store", "b", "--full", "--since", "2020-01-01"])
