"""How often rows are shuffled, and how many tasks take them."""

from __future__ import annotations

from datetime import date

from conftest import plan_of
from depotlake.operators import marts, upsert
from depotlake.plans import job_queries, jobs, write_queries
from depotlake.session import SHUFFLE_CLEANUP
from depotlake.sources import tables, writers
from depotlake.sources.store import FILE, FILE_ROW, MAIN
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"


def exchanges(df: DataFrame) -> int:
    return plan_of(df).split("== Initial Plan ==")[-1].count("Exchange hashpartitioning(")


def test_daily_marts_shuffle_their_rows_once(silver_rows):
    rows = silver_rows({"trade_id": 1})
    assert exchanges(marts.daily_security(rows)) == 1
    assert exchanges(marts.broker_daily(rows)) == 1


def test_broker_counts_skip_missing_values_and_repeats(silver_rows):
    day = date(2000, 1, 3)
    rows = [dict(trade_id=n, trade_date=day, broker_id=broker, channel="A", investor_id=i, security_id=s)
            for n, (broker, i, s) in enumerate([(1, 5, 6), (1, 5, None), (1, None, 6), (1, 7, 6), (None, None, None), (None, 4, 4)])]
    got = {r["broker_id"]: (r["trade_count"], r["unique_investors"], r["unique_securities"])
           for r in marts.broker_daily(silver_rows(*rows)).collect()}
    assert got == {1: (4, 2, 1), None: (2, 1, 1)}


def test_writes_leave_no_shuffle_files(store, trade_rows, monkeypatch):
    seen, write = [], writers.write_clustered

    def noted(*args, **kwargs):
        seen.append(store.spark.conf.get(SHUFFLE_CLEANUP))
        write(*args, **kwargs)

    monkeypatch.setattr("depotlake.sources.store.write_clustered", noted)
    before = store.spark.conf.get(SHUFFLE_CLEANUP)
    store.write("a", trade_rows({"trade_id": 1}), MAIN)
    store.write_together(MAIN, [{"table": t, "df": trade_rows({"trade_id": 1})} for t in ("b", "c")])
    assert seen == ["true"] * 3 and store.spark.conf.get(SHUFFLE_CLEANUP) == before


def test_fixed_numbers_of_files_follow_the_input(spark, monkeypatch):
    lines = tables.table(spark, FOLDER, "lineitem").count()
    monkeypatch.setattr(tables, "ROWS_PER_TASK", lines // 8)
    assert tables.tasks_for_trades(spark, FOLDER, 4) in (8, 12)
    assert job_queries.orphan_files(spark, FOLDER).first()["files"] >= 8
    per_batch, run = [], write_queries.stream_upsert

    def noted(*args, **kwargs):
        per_batch.append(kwargs["files_per_batch"])
        run(*args, **kwargs)

    monkeypatch.setattr(write_queries, "stream_upsert", noted)
    write_queries.streamed(spark, FOLDER)
    assert per_batch[0] >= 2


def test_the_serving_copy_of_the_daily_mart_is_not_shuffled(spark, monkeypatch):
    dealt, write = {}, writers.write_clustered

    def noted(df, path, *args, **kwargs):
        dealt[path.split("/data/")[1].split("/")[0]] = kwargs["dealt"]
        write(df, path, *args, **kwargs)

    monkeypatch.setattr("depotlake.sources.store.write_clustered", noted)
    store = job_queries.published_faulty(spark, FOLDER, "dealt")
    assert [table for table, is_dealt in dealt.items() if is_dealt] == [jobs.SERVING_DAILY]
    names = store.columns(jobs.DAILY)
    mart, copy = (store.read(t).select(*names) for t in (jobs.DAILY, jobs.SERVING_DAILY))
    assert mart.exceptAll(copy).isEmpty() and copy.exceptAll(mart).isEmpty()


def test_the_order_inside_files_is_looked_at_by_blocks_of_rows(spark):
    """Files of one row and of many, with repeats, NULLs and borders of blocks in falling and rising places."""
    values = {"a": [5, 4, 4, None, 3, 9, 1, 1, 2, 0], "b": [7], "c": list(range(40)), "d": [None, None, 3, 2]}
    rows = spark.createDataFrame([(f"file:/{name}", at, value, name) for name, held in values.items()
                                  for at, value in enumerate(held)], f"{FILE} string, {FILE_ROW} long, v int, month string")
    expected = sorted((name, str(value), at > 0 and None not in (value, held[at - 1]) and held[at - 1] > value)
                      for name, held in values.items() for at, value in enumerate(held))
    for block in (1, 3, 5, 1000):
        flagged = job_queries.sorted_inside(rows, "v", "month", block=block)
        assert sorted((r["month"], str(r["v"]), r["out_of_order"]) for r in flagged.collect()) == expected
    # Paths are not shuffled, and one file goes to several tasks.
    exchanged = [line for line in plan_of(flagged).splitlines() if "Exchange" in line]
    assert exchanged and not any(FILE + "#" in line for line in exchanged)
    tasks = job_queries.sorted_inside(rows.where("month = 'c'"), "v", block=3).select(F.spark_partition_id()).distinct()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert tasks.count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_rows_without_a_key_stay_out_of_the_join(trade_rows):
    rows = trade_rows({"trade_id": None}, {"trade_id": None, "broker_id": 7}, {"trade_id": 1}, {"trade_id": 2})
    rest = upsert.without(rows, trade_rows({"trade_id": 2}, {"trade_id": None}), "trade_id", limit=0)
    assert rest.columns == rows.columns
    assert sorted((r["trade_id"] or 0, r["broker_id"]) for r in rest.collect()) == [(0, 5), (0, 7), (1, 5)]
    # One shuffle for each side of the join, of rows that have a key; the others reach the union as they are.
    assert rest._jdf.queryExecution().optimizedPlan().toString().count("Union") == 1


def test_the_keyless_feed_is_read_from_the_store(spark, trade_rows, monkeypatch):
    rows = trade_rows(*({"trade_id": key} for key in (1, 2, 5, 10, 10)))
    monkeypatch.setattr(tables, "trades", lambda spark, folder: rows)
    feeds = []

    def kept(store, table, feed, ref):
        feeds.append(feed)
        return upsert.upsert_into(store, table, feed, ref)

    monkeypatch.setattr(write_queries, "upsert_into", kept)
    found = sorted((r["trade_id"] or 0) for r in write_queries.upsert_null_keys(spark, "unused").collect())
    assert found == [0, 0, 0, 0, 1, 2]
    # Neither the delivery nor its ranks are worked out a second time.
    assert "FileScan parquet" in plan_of(feeds[0]) and "Window" not in plan_of(feeds[0])


def test_a_feed_with_rows_without_a_key_needs_no_join_to_be_new(store, trade_rows, monkeypatch):
    store.write("trade", trade_rows({"trade_id": 1}), MAIN, "load")
    feed, asked = trade_rows({"trade_id": 1}, {"trade_id": None}), []
    monkeypatch.setattr(type(feed), "isEmpty", lambda df, own=type(feed).isEmpty: asked.append(plan_of(df)) or own(df))
    upsert.upsert_into(store, "trade", feed, MAIN)
    assert sorted(r["trade_id"] or 0 for r in store.read("trade").collect()) == [0, 1]
    assert asked and not any("Join" in plan for plan in asked)
    asked.clear()
    assert upsert.upsert_into(store, "trade", trade_rows({"trade_id": 1}), MAIN) == 2


def test_marts_are_written_where_their_rows_were_dealt(spark, monkeypatch):
    """One shuffle for a mart and its layout; groups and positions are those of a plain aggregate, also of rows without a day."""
    plans, write = {}, writers.write_clustered

    def noted(df, path, *args, **kwargs):
        plans[path.split("/data/")[1].split("/")[0]] = (kwargs["grouped"], exchanges(df), plan_of(df))
        write(df, path, *args, **kwargs)

    monkeypatch.setattr("depotlake.sources.store.write_clustered", noted)
    store = job_queries.published_faulty(spark, FOLDER, "grouped")
    grouped = {table: count for table, (is_grouped, count, _) in plans.items() if is_grouped}
    assert grouped == {jobs.DAILY: 1, jobs.POSITION: 1, jobs.BROKER: 1}
    silver = jobs.silver_view(store)
    for table, keys in ((jobs.DAILY, jobs.DAILY_KEYS), (jobs.BROKER, jobs.BROKER_KEYS)):
        plain = silver.groupBy(*keys).agg(F.count(F.lit(1)).alias("trade_count"), F.count_distinct("investor_id").alias("unique_investors"))
        mart = store.read(table).select(*plain.columns)
        assert mart.exceptAll(plain).isEmpty() and plain.exceptAll(mart).isEmpty()
    plain = marts.positions(silver)
    held = store.read(jobs.POSITION).select(*plain.columns)
    assert held.exceptAll(plain).isEmpty() and plain.exceptAll(held).isEmpty()
    # The layout of resolved trades takes rows that were written before, so dedup and joins leave nothing beside it.
    assert "FileScan parquet" in plans[jobs.RESOLVED][2] and "Join" not in plans[jobs.RESOLVED][2]


def test_marts_of_missing_days_and_ids(silver_rows):
    rows = silver_rows({"trade_date": None}, {"trade_date": None, "security_id": None}, {"security_id": None}, {"broker_id": None},
                       {"investor_id": None}, {"investor_id": None, "security_id": None})
    assert sorted(r["trade_count"] for r in marts.daily_security(rows).collect()) == [1, 1, 2, 2]
    assert sorted(r["trade_count"] for r in marts.broker_daily(rows).collect()) == [1, 2, 3]
    for bucket in (None, "pmod(hash(investor_id), 16)"):
        found = marts.positions(rows, bucket)
        assert "_place" not in found.columns and sorted(r["trade_count"] for r in found.collect()) == [1, 1, 2, 2]
