"""Keyed upserts, change feeds, sets of investors, numbering and sessions."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from conftest import plan_of
from depotlake.operators import investor_sets, versions
from depotlake.operators.numbering import numbered
from depotlake.operators.upsert import part_values, reachable_parts, upsert_into
from depotlake.plans.jobs import MONTHLY, keyed_layout
from depotlake.session import workspace
from depotlake.sources.store import MAIN
from depotlake.streaming.sessions import stream_sessions
from pyspark.sql import functions as F

OLD, NEW = datetime(2020, 1, 15, 10), datetime(2020, 3, 1)
DAYS = [datetime(2020, month, 10) for month in (1, 2, 3)]


def trades_of(trade_rows, keys, **values):
    return trade_rows(*({"trade_id": key, "trade_ts": DAYS[key % 3], **values} for key in keys))


@pytest.fixture
def keyed(store, trade_rows):
    """60 trades in three months and eight buckets of the key."""
    store.write("trade", trades_of(trade_rows, range(60)), MAIN, "load", keyed_layout(8), ("trade_ts",))
    return store


def buckets(spark, keys):
    rows = spark.createDataFrame([(k,) for k in keys], "k bigint").selectExpr("pmod(hash(k), 8) as b").distinct()
    return {str(r["b"]) for r in rows.collect()}


def test_a_batch_reads_and_rewrites_only_its_buckets(spark, keyed, trade_rows, monkeypatch):
    changes = trades_of(trade_rows, (3, 6), broker_id=9, updated_ts=NEW)
    seen = []
    read = type(keyed).read

    def spy(self, table, *args, **kwargs):
        seen.append(kwargs.get("parts"))
        return read(self, table, *args, **kwargs)

    monkeypatch.setattr(type(keyed), "read", spy)
    before = {p["dir"] for p in keyed.manifest("trade", 1)["parts"]}
    upsert_into(keyed, "trade", changes, MAIN)
    after = {p["dir"] for p in keyed.manifest("trade", 2)["parts"]}
    wanted = buckets(spark, (3, 6))
    looked_at, rewritten = seen[0], before - after
    assert {part_values(p)["key_bucket"] for p in looked_at} == wanted and len(looked_at) < len(before)
    assert {part_values(p)["key_bucket"] for p in rewritten} == wanted
    assert {part_values(p)["trade_month"] for p in rewritten} == {"2020-01"}
    monkeypatch.undo()
    rows = {r["trade_id"]: r["broker_id"] for r in keyed.read("trade").collect()}
    assert rows == {k: 9 if k in (3, 6) else 5 for k in range(60)}


def test_columns_declared_immutable_choose_folders_too(keyed, trade_rows):
    changes = trades_of(trade_rows, (3,), updated_ts=NEW)
    loose = reachable_parts(keyed, "trade", 1, changes, "trade_id")
    tight = reachable_parts(keyed, "trade", 1, changes, "trade_id", ("trade_ts",))
    assert set(tight) < set(loose) and {part_values(p)["trade_month"] for p in tight} == {"2020-01"}


def test_a_row_that_moves_to_another_month_leaves_its_bucket_there(keyed, trade_rows):
    upsert_into(keyed, "trade", trade_rows({"trade_id": 3, "trade_ts": DAYS[2], "updated_ts": NEW}), MAIN)
    rows = keyed.read("trade").filter("trade_id = 3").collect()
    assert [r["trade_ts"] for r in rows] == [DAYS[2]] and keyed.read("trade").count() == 60


def test_layouts_without_the_key_and_older_parts_are_read_as_a_whole(store, trade_rows):
    store.write("plain", trades_of(trade_rows, range(6)), MAIN, "load", MONTHLY)
    changes = trades_of(trade_rows, (1,), updated_ts=NEW)
    assert reachable_parts(store, "plain", 1, changes, "trade_id") is None
    columns = store.manifest("plain", 1)["columns"]
    spec = [{"name": n, "expr": e, "type": t} for (n, e), t in zip(keyed_layout(8).items(), ("int", "string"))]
    store.change_schema("plain", MAIN, "change layout", columns, spec)
    assert len(reachable_parts(store, "plain", 2, changes, "trade_id")) == 3
    upsert_into(store, "plain", trades_of(trade_rows, (1, 99), updated_ts=NEW), MAIN)
    assert store.read("plain").count() == 7


@pytest.mark.parametrize("keys, total", [((), 60), ((None,), 61), ((100, None, None), 63), ((3, 3), 60)])
def test_batches_without_known_keys(keyed, trade_rows, keys, total):
    rows = trade_rows(*({"trade_id": key, "trade_ts": DAYS[0], "updated_ts": NEW} for key in keys))
    upsert_into(keyed, "trade", rows, MAIN)
    assert keyed.read("trade").count() == total


# ---- change feed

def changes_of(store, before, after):
    rows = versions.version_changes(store, "trade", before, after).collect()
    return sorted(((r["change"], r["trade_id"], r["broker_id"], r["copies"]) for r in rows), key=str)


def test_change_feed_of_updates_additions_and_deletions(keyed, trade_rows):
    upsert_into(keyed, "trade", trades_of(trade_rows, (3, 70), broker_id=9, updated_ts=NEW), MAIN)
    assert changes_of(keyed, 1, 2) == [("added", 70, 9, 1), ("updated", 3, 9, 1)]
    assert changes_of(keyed, 2, 1) == [("deleted", 70, 9, 1), ("updated", 3, 5, 1)]
    assert changes_of(keyed, 2, 2) == []
    history = versions.version_history(keyed, "trade").orderBy("version").collect()
    assert [tuple(r) for r in history] == [(1, None, "load", 60, 0, 0), (2, 1, "upsert", 1, 0, 1)]


def test_change_feed_of_rows_without_a_key(store, trade_rows):
    none = {"trade_id": None}
    store.write("trade", trade_rows(none, none, {"trade_id": 1}), MAIN, "load")
    store.write("trade", trade_rows(none, none, none, {**none, "broker_id": 8}, {"trade_id": 1}), MAIN, "again")
    assert changes_of(store, 1, 2) == [("added", None, 5, 1), ("added", None, 8, 1)]
    assert changes_of(store, 2, 1) == [("deleted", None, 5, 1), ("deleted", None, 8, 1)]


def test_change_feed_does_not_read_shared_parts(keyed, trade_rows):
    upsert_into(keyed, "trade", trades_of(trade_rows, (3,), broker_id=9, updated_ts=NEW), MAIN)
    files = versions.version_changes(keyed, "trade", 1, 2).inputFiles()
    assert len({file.rsplit("/", 1)[0] for file in files}) == 2


# ---- sets of investors

@pytest.mark.parametrize("first, last, months", [
    ((2020, 1, 1), (2020, 3, 31), ((2020, 1, 1), (2020, 3, 31))), ((2020, 1, 2), (2020, 3, 30), ((2020, 2, 1), (2020, 2, 29))),
    ((2020, 1, 2), (2020, 2, 28), None), ((2020, 1, 1), (2020, 1, 31), ((2020, 1, 1), (2020, 1, 31))),
    ((2020, 1, 5), (2020, 1, 5), None), ((2019, 12, 31), (2020, 1, 1), None)])
def test_whole_months(first, last, months):
    found = investor_sets.whole_months(date(*first), date(*last))
    assert found == (months and (date(*months[0]), date(*months[1])))


@pytest.mark.parametrize("first, last", [((2020, 1, 1), (2020, 3, 31)), ((2020, 1, 20), (2020, 3, 5)),
                                         ((2020, 1, 3), (2020, 1, 9)), ((2021, 1, 1), (2021, 2, 1))])
def test_sets_count_investors_of_any_range(silver_rows, first, last):
    rng = random.Random(2)
    rows = [{"investor_id": rng.choice([None, -5, 0, 7, 32_768, 32_769, 10 ** 9, rng.randrange(50)]),
             "trade_date": date(2020, 1, 1) + timedelta(days=rng.randrange(91)), "channel": rng.choice("AB"),
             "security_type": rng.choice(["X", "Y"])} for _ in range(300)]
    silver, first, last = silver_rows(*rows), date(*first), date(*last)
    sets = investor_sets.monthly_investors(silver)
    got = investor_sets.investors_between(sets, silver, first, last, of=F.col("security_type") == "X")
    wanted = {}
    for row in rows:
        if first <= row["trade_date"] <= last and row["security_type"] == "X" and row["investor_id"] is not None:
            wanted.setdefault(row["channel"], set()).add(row["investor_id"])
    assert {r["channel"]: r["unique_investors"] for r in got.collect()} == {k: len(v) for k, v in wanted.items()}


# ---- numbering

def test_numbers_follow_the_order_without_a_window(spark):
    rng = random.Random(5)
    rows = [(k, rng.choice([None, 0, 0, 0, 1, 2])) for k in range(500)]
    got = numbered(spark.createDataFrame(rows, "id int, value int"), [F.asc_nulls_first("value")], tie="id")
    assert "Window" not in plan_of(got) and "SinglePartition" not in plan_of(got)
    wanted = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[0]))
    assert [(r["id"], r["number"]) for r in got.orderBy("number").collect()] == [
        (row[0], k) for k, row in enumerate(wanted, 1)]


def test_numbering_repeated_rows_and_none(spark):
    same = spark.createDataFrame([(1,)] * 20, "id int")
    assert sorted(r["number"] for r in numbered(same, [F.col("id")]).collect()) == list(range(1, 21))
    assert numbered(same.filter("id > 1"), [F.col("id")]).count() == 0


# ---- sessions

def test_sessions_go_on_after_a_restart_and_late_events_are_dropped(spark, store):
    start = datetime(2024, 1, 1)

    def events(*minutes):
        rows = [(k, start + timedelta(minutes=m), user, kind, 1.25) for k, (m, user, kind) in enumerate(minutes)]
        return spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double")

    root = workspace(spark, "test-sessions")
    steps = [events((0, 1, "view"), (20, 1, "purchase"), (100, 2, "view"), (5, None, "view")),
             # User 1 has been quiet for long, user 2 goes on; one event comes after its session was closed.
             events((115, 2, "click"), (10, 1, "click"), (300, 3, "view")), events((600, 4, "view"))]
    seen = []
    for step in steps:
        step.coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream_sessions(store, f"{root}/in", step.schema, f"{root}/checkpoint", f"{root}/out", "30 minutes", "10 minutes")
        seen.append(sorted((r["user_id"], r["session_start"], r["session_end"], r["events"], r["purchases"], str(r["total_value"]))
                           for r in spark.read.parquet(f"{root}/out").collect()))

    def session(user, first, last, count, purchases):
        return (user, start + timedelta(minutes=first), start + timedelta(minutes=last + 30), count, purchases, str(count * 1.25) + "0" * (count % 2 == 0))

    assert seen[0] == [session(1, 0, 20, 2, 1)]
    assert seen[1] == seen[0] + [session(2, 100, 115, 2, 0)]
    assert seen[2] == seen[1] + [session(3, 300, 300, 1, 0)]


# ---- serving copies

def test_serving_refresh_reads_and_writes_changed_months_only(spark, monkeypatch):
    from depotlake.operators import marts
    from depotlake.plans import growth_queries, jobs, serving_delta
    store = growth_queries.changed_month(spark, "/root/testdata/sf0.001")
    month, seen = growth_queries.CHANGED_MONTH, []
    aggregate = marts.daily_security
    monkeypatch.setattr(marts, "daily_security", lambda rows: seen.append(rows.inputFiles()) or aggregate(rows))
    before = {t: {p["dir"] for p in store.manifest(t, store.state()[t])["parts"]} for t in (jobs.SERVING_DAILY, jobs.SERVING_TRADE)}
    serving_delta.refresh_serving_delta(store)
    monkeypatch.undo()
    plan = seen[0] and aggregate(jobs.silver_view(store).filter(F.col("trade_month") == month))
    for table, old in before.items():
        new = {p["dir"] for p in store.manifest(table, store.state()[table])["parts"]}
        assert {part_values(d)["trade_month"] for d in old ^ new} == {month}
    names = [c for c in store.columns(jobs.SERVING_DAILY)]
    daily = store.read(jobs.SERVING_DAILY)
    assert daily.filter(F.col("trade_month") == month).select(*names).exceptAll(plan.select(*names)).isEmpty()
    silver = jobs.silver_view(store)
    assert daily.select(*names).exceptAll(marts.daily_security(silver).select(*names)).isEmpty()
    position = marts.positions(silver)
    copy = store.read(jobs.SERVING_POSITION).select(*position.columns)
    assert copy.exceptAll(position).isEmpty() and position.exceptAll(copy).isEmpty()
    assert store.read(jobs.SERVING_TRADE).count() == silver.count()
    assert serving_delta.refresh_serving_delta(store) is None


def test_serving_delta_prunes_folders_in_its_plan(spark):
    from depotlake.plans import growth_queries, jobs, serving_delta
    store = growth_queries.changed_month(spark, "/root/testdata/sf0.001")
    found = serving_delta.delta(store, 1, store.state()[jobs.RESOLVED])
    assert found.months == [growth_queries.CHANGED_MONTH] and found.before and found.after
    assert jobs.misplaced(jobs.with_outcome(store, "valid")) == 0
    assert store.applied(jobs.SERVING_DAILY, MAIN, jobs.SOURCE) == 1
    assert store.applied(jobs.SERVING_TRADE, MAIN, jobs.ALIGNED) in (-1, 1)


def test_change_feed_shuffles_no_whole_rows(store, trade_rows):
    """Rows are compared by hashes, which tell a missing value from one of its neighbour."""
    def rows(investor, security):
        return trade_rows({"investor_id": investor, "security_id": security}, {"trade_id": 2},
                          {"trade_id": None}, {"trade_id": None, "broker_id": 9})

    store.write("trade", rows(7, None), MAIN, layout=MONTHLY)
    store.write("trade", rows(None, 7).unionByName(trade_rows({"trade_id": None}, {"trade_id": None})), MAIN, layout=MONTHLY)
    found = [(r.change, r.copies, r.trade_id, r.security_id) for r in versions.version_changes(store, "trade", 1, 2).collect()]
    assert sorted(found, key=str) == [("added", 2, None, 100), ("updated", 1, 1, 7)]
    back = [(r.change, r.copies, r.trade_id, r.investor_id) for r in versions.version_changes(store, "trade", 2, 1).collect()]
    assert sorted(back, key=str) == [("deleted", 2, None, 10), ("updated", 1, 1, 7)]
    plan = versions.version_diff(store, "trade", 1, 2)._jdf.queryExecution().optimizedPlan().toString()
    steps = [line for line in plan.splitlines() if any(step in line for step in ("Aggregate", "Window", "Repartition"))]
    assert steps and not any("channel" in line for line in steps)
