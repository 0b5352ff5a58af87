from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from conftest import plan_of
from depotlake.operators import marts, reconcile
from depotlake.operators.quality import QualityError
from depotlake.plans import jobs
from depotlake.sources.store import MAIN
from depotlake.streaming.ingest import stream_upsert
from depotlake.model import TRADE
from depotlake.session import workspace

FEB = {"trade_ts": datetime(2020, 2, 3, 11), "trade_date": date(2020, 2, 3),
       "updated_ts": datetime(2020, 2, 3, 11)}


@pytest.fixture
def feed(trade_rows):
    return trade_rows({}, {"trade_id": 2, "security_id": 101}, {"trade_id": 3, **FEB},
                      {"trade_id": 4, "investor_id": 99})


@pytest.fixture
def lake(store, feed, investors, securities):
    jobs.run_all(store, feed, investors, securities)
    return store


def rows(df):
    return sorted(tuple(map(str, r)) for r in df.collect())


def test_all_layers_are_published(lake):
    assert set(lake.state()) == set(jobs.PUBLISHED)
    assert jobs.silver_view(lake).count() == 3
    held = jobs.quarantine_view(lake).collect()
    assert [r.reason for r in held] == ["no matching investor"] and held[0].quarantined_at is not None
    assert jobs.with_outcome(lake, "valid").filter("quarantined_at is not null").isEmpty()
    assert lake.read(jobs.SERVING_TRADE).count() == 3
    assert jobs.expected_tables(lake).filter("status = 'MISSING'").count() == 0
    assert jobs.expected_tables(lake, ["x", jobs.DAILY]).filter("status = 'MISSING'").count() == 1


def test_running_twice_changes_nothing(lake, feed, investors, securities):
    def content():
        return {t: rows(lake.read(t).drop("_ingest_ts", "_ingest_job", "calculated_at", "quarantined_at"))
                for t in jobs.PUBLISHED}
    first = content()
    jobs.run_all(lake, feed, investors, securities)
    assert content() == first


def test_a_dirty_batch_stays_on_its_stage(lake, trade_rows):
    before = lake.state()
    with pytest.raises(QualityError, match="amount not positive"):
        jobs.load_bronze(lake, trade_rows({"amount": Decimal(-1)}))
    assert lake.state() == before
    stage = [r for r in lake.refs() if r.startswith("etl_bronze") and
             lake.read(jobs.BRONZE, r).filter("amount < 0").count()]
    assert len(stage) == 1
    assert lake.refs() == sorted([*stage, MAIN])
    with pytest.raises(ValueError):
        lake.drop_ref(MAIN)


def test_keeping_the_stage_for_inspection(store, feed):
    ref = jobs.load_bronze(store, feed, publish=False)
    assert store.state() == {}
    assert store.read(jobs.BRONZE, ref).count() == 4


def test_repeated_keys_block_unless_the_feed_may_repeat(store, trade_rows):
    with pytest.raises(QualityError, match="repeated"):
        jobs.load_bronze(store, trade_rows({}, {}))
    jobs.load_bronze(store, trade_rows({}, {}), unique=False)
    assert store.read(jobs.BRONZE).count() == 2


def test_a_full_load_from_a_shrunk_source_leaves_no_old_month(lake, trade_rows, investors, securities):
    jobs.run_all(lake, trade_rows(FEB), investors, securities)
    for table in (jobs.BRONZE, jobs.RESOLVED, jobs.DAILY, jobs.SERVING_TRADE):
        assert {r.trade_month for r in lake.read(table).collect()} == {"2020-02"}


def test_increments_start_at_the_newest_change(store, trade_rows):
    jobs.load_bronze(store, trade_rows({}), mode="incremental")
    late = trade_rows({"trade_id": 2, "updated_ts": datetime(2019, 1, 1)}, {"trade_id": 3, **FEB})
    jobs.load_bronze(store, late, mode="incremental")
    assert sorted(r.trade_id for r in store.read(jobs.BRONZE).collect()) == [1, 3]
    jobs.load_bronze(store, late, mode="incremental", since=datetime(2019, 1, 1))
    assert sorted(r.trade_id for r in store.read(jobs.BRONZE).collect()) == [1, 2, 3]
    with pytest.raises(ValueError):
        jobs.load_bronze(store, late, mode="other")


def test_a_closed_partition_disappears_from_the_positions(lake, trade_rows, feed, investors, securities):
    sold = feed.unionByName(trade_rows({"trade_id": 7, "security_id": 101, "side": "SELL"}))
    assert {r.security_type for r in lake.read(jobs.POSITION).collect()} == {"STOCK", "BOND"}
    jobs.run_all(lake, sold, investors, securities)
    assert {r.security_type for r in lake.read(jobs.POSITION).collect()} == {"STOCK"}


def test_audits_stop_wrong_marts(lake):
    lake.create_ref("stage")
    wrong = lake.read(jobs.DAILY).drop("trade_month")
    lake.append(jobs.DAILY, wrong, "stage")
    with pytest.raises(QualityError):
        jobs.audit_gold(lake, "stage")
    lake.create_ref("lost")
    resolved = lake.read(jobs.RESOLVED).filter("outcome = 'valid'").select(
        *lake.columns(jobs.RESOLVED))
    lake.write(jobs.RESOLVED, resolved, "lost")
    with pytest.raises(QualityError, match="add up"):
        jobs.audit_silver(lake, "lost")


def test_verify_lists_all_checks_before_failing(lake, spark, feed):
    views = jobs.register_views(lake)
    valid = feed.filter("investor_id = 10")
    checks = jobs.verify(lake, marts.eod_balance(valid), views)
    assert checks.count() == 8
    reconcile.require_passed(checks)
    broken = jobs.verify(lake, marts.eod_balance(feed), [*views, "absent_view"])
    assert broken.count() == 8
    with pytest.raises(reconcile.ReconciliationError) as error:
        reconcile.require_passed(broken)
    assert "published views" in str(error.value) and "only in the balance" in str(error.value)


def test_views_stay_on_the_published_version(lake, spark):
    jobs.register_views(lake)
    lake.create_ref("stage")
    extra = lake.read(jobs.BROKER).drop("trade_month")
    lake.append(jobs.BROKER, extra, "stage")
    seen = spark.sql("select count(*) as n from gold_broker_daily").first().n
    assert seen == extra.count()


def test_serving_copies_refuse_nulls(spark, silver_rows):
    rows = silver_rows({"channel": None}).select(jobs.required("channel", "string"))
    with pytest.raises(Exception, match="channel is null"):
        rows.collect()


def test_views_have_the_declared_columns_only(lake, spark):
    jobs.register_views(lake)
    for view, table in (("bronze_trade", jobs.BRONZE), ("gold_position", jobs.POSITION), ("gold_daily_security", jobs.DAILY)):
        assert spark.table(view).columns == lake.columns(table)
    layouts = {table: {p["name"]: p["expr"] for p in lake.manifest(table, lake.state()[table])["layout"]}
               for table in (jobs.RESOLVED, jobs.POSITION)}
    assert layouts == {jobs.RESOLVED: jobs.RESOLVED_LAYOUT, jobs.POSITION: jobs.position_layout()}


def test_the_outcome_prunes_folders(lake):
    assert "PartitionFilters: [isnotnull(outcome_part" in plan_of(jobs.silver_view(lake))


def test_a_wrong_position_stops_the_run(store, feed, investors, securities):
    balance = marts.eod_balance(jobs_valid(store, feed, investors, securities))
    jobs.run_all(store, feed, investors, securities, balance=balance)
    wrong = balance.withColumn("nominal_qty", F.col("nominal_qty") + 1)
    with pytest.raises(reconcile.ReconciliationError):
        jobs.run_all(store, feed, investors, securities, balance=wrong)


def jobs_valid(store, feed, investors, securities):
    jobs.run_all(store, feed, investors, securities)
    return jobs.silver_view(store)


def test_a_lost_and_a_repeated_row_do_not_cancel(lake):
    resolved = lake.read(jobs.RESOLVED).select(*lake.columns(jobs.RESOLVED))
    valid = resolved.filter("outcome = 'valid'")
    lost, kept = [r.trade_id for r in valid.select("trade_id").orderBy("trade_id").limit(2).collect()]
    lake.write(jobs.RESOLVED, resolved.filter(F.col("trade_id") != lost).unionByName(
        valid.filter(F.col("trade_id") == kept)), MAIN, "damage")
    row = jobs.verify(lake, marts.eod_balance(valid), []).filter("check_no = 6").first()
    assert not row.passed


def test_a_bad_batch_stays_on_its_stage(spark, store, trade_rows):
    scratch = workspace(spark, "bad-stream")

    def stream():
        stream_upsert(store, "trade", f"{scratch}/feed", TRADE, f"{scratch}/checkpoint", "changes",
                      lambda batch: jobs.audit_bronze(batch, unique=False), files_per_batch=1)
    trade_rows({}).coalesce(1).write.mode("append").parquet(f"{scratch}/feed")
    stream()
    trade_rows({"trade_id": 2, "qty": None}).coalesce(1).write.mode("append").parquet(f"{scratch}/feed")
    with pytest.raises(Exception, match="qty is null"):
        stream()
    assert [r.trade_id for r in store.read("trade").collect()] == [1]
    assert len(store.refs()) == 2


def test_stream_equals_batch_and_survives_a_replay(spark, store, trade_rows):
    scratch = workspace(spark, "stream-test")
    changes = [[{}, {"trade_id": 2}], [{"broker_id": 6, **FEB}],
               [{"broker_id": 7}, {"trade_id": 3}]]
    for batch in changes:
        trade_rows(*batch).coalesce(1).write.mode("append").parquet(f"{scratch}/feed")

    def run(checkpoint):
        stream_upsert(store, "trade", f"{scratch}/feed", TRADE, f"{scratch}/{checkpoint}", "changes",
                      lambda batch: None, files_per_batch=1)
        return {r.trade_id: r.broker_id for r in store.read("trade").collect()}

    assert run("first") == {1: 6, 2: 5, 3: 5}
    versions = store.versions("trade")
    assert run("first") == {1: 6, 2: 5, 3: 5}
    # A lost checkpoint delivers every file again, in a batch with a new one.
    trade_rows({"trade_id": 4}).coalesce(1).write.mode("append").parquet(f"{scratch}/feed")
    assert run("second") == {1: 6, 2: 5, 3: 5, 4: 5}
    assert len(store.versions("trade")) == len(versions) + 1
    versions = store.versions("trade")
    assert store.state()["trade"] == versions[-1]
    assert MAIN in store.refs()
