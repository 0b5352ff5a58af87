from __future__ import annotations

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from depotlake.operators import upsert
from depotlake.operators.upsert import merge, update_where, upsert_into
from depotlake.plans.jobs import MONTHLY
from depotlake.sources.store import MAIN
from pyspark.sql import functions as F

OLD, NOW, NEW = datetime(2020, 1, 1), datetime(2020, 1, 15, 10), datetime(2020, 2, 1)


def brokers(df):
    return {r.trade_id: r.broker_id for r in df.collect()}


CASES = {
    "newer replaces": ([{}], [{"broker_id": 6, "updated_ts": NEW}], {1: 6}),
    "older is ignored": ([{}], [{"broker_id": 6, "updated_ts": OLD}], {1: 5}),
    "equally old is ignored": ([{}], [{"broker_id": 6}], {1: 5}),
    "no stamp is ignored": ([{}], [{"broker_id": 6, "updated_ts": None}], {1: 5}),
    "target without stamp stays": ([{"updated_ts": None}], [{"broker_id": 6}], {1: 5}),
    "unknown key comes in": ([{}], [{"trade_id": 2, "broker_id": 6, "updated_ts": None}], {1: 5, 2: 6}),
    "repeated source key": ([{}], [{"broker_id": 6, "updated_ts": NEW}, {"broker_id": 7, "updated_ts": NEW},
                                   {"broker_id": 8, "updated_ts": OLD}], {1: 7}),
    "empty source": ([{}], [], {1: 5}),
    "empty target": ([], [{"broker_id": 6}], {1: 6}),
}


@pytest.mark.parametrize("case", CASES)
def test_merge(trade_rows, case):
    target, source, expected = CASES[case]
    assert brokers(merge(trade_rows(*target), trade_rows(*source))) == expected


@pytest.mark.parametrize("case", [c for c in CASES if c != "empty target"])
def test_stored_upsert_agrees(store, trade_rows, case):
    target, source, expected = CASES[case]
    store.write("trade", trade_rows(*target), MAIN, layout=MONTHLY)
    upsert_into(store, "trade", trade_rows(*source), MAIN)
    assert brokers(store.read("trade")) == expected


def test_merge_against_brute_force(store, trade_rows):
    rng = random.Random(7)

    def rows(n, unique):
        made = {}
        for i in range(n):
            key = rng.randrange(40)
            day = timedelta(days=rng.randrange(90))
            made[key if unique else i] = {
                "trade_id": key, "broker_id": rng.randrange(1000), "trade_ts": OLD + day,
                "updated_ts": rng.choice([None, OLD + timedelta(days=rng.randrange(4))])}
        return list(made.values())

    target, source = rows(40, True), rows(60, False)
    low = datetime.min
    expected = {r["trade_id"]: r["broker_id"] for r in target}
    stamps = {r["trade_id"]: r["updated_ts"] for r in target}
    best = {}
    for r in source:
        rank = (r["updated_ts"] or low, r["broker_id"])
        if r["trade_id"] not in best or rank > best[r["trade_id"]][0]:
            best[r["trade_id"]] = (rank, r)
    for key, (_, r) in best.items():
        known = key in stamps
        if not known or (r["updated_ts"] and stamps[key] and r["updated_ts"] > stamps[key]):
            expected[key] = r["broker_id"]
    assert brokers(merge(trade_rows(*target), trade_rows(*source))) == expected
    store.write("trade", trade_rows(*target), MAIN, layout=MONTHLY)
    upsert_into(store, "trade", trade_rows(*source), MAIN)
    assert brokers(store.read("trade")) == expected
    assert store.read("trade").count() == len(expected)


def test_a_row_that_moves_leaves_its_old_month(store, trade_rows):
    store.write("trade", trade_rows({}, {"trade_id": 2}), MAIN, layout=MONTHLY)
    upsert_into(store, "trade", trade_rows({"trade_ts": datetime(2020, 5, 1), "updated_ts": NEW}), MAIN)
    months = {r.trade_id: r.trade_month for r in store.read("trade").collect()}
    assert months == {1: "2020-05", 2: "2020-01"}


def test_untouched_parts_are_shared(store, trade_rows):
    rows = [{"trade_id": i, "trade_ts": datetime(2020, i, 1)} for i in range(1, 7)]
    store.write("trade", trade_rows(*rows), MAIN, layout=MONTHLY)
    before = {p["dir"] for p in store.manifest("trade", 1)["parts"]}
    version = upsert_into(store, "trade", trade_rows(
        {"trade_id": 3, "trade_ts": datetime(2020, 3, 1), "broker_id": 6, "updated_ts": NEW}), MAIN)
    after = {p["dir"] for p in store.manifest("trade", version)["parts"]}
    assert len(before & after) == 5 and len(after) == 6
    assert store.read("trade").count() == 6


def test_a_batch_of_a_feed_applies_once(store, trade_rows):
    first = upsert_into(store, "trade", trade_rows({"broker_id": 6}), MAIN, batch=("q", 0))
    other = trade_rows({"trade_id": 2})
    assert upsert_into(store, "trade", other, MAIN, batch=("q", 0)) == first
    assert upsert_into(store, "trade", other, MAIN, batch=("q", 1)) == 2
    assert upsert_into(store, "trade", trade_rows({"trade_id": 3}), MAIN, batch=("r", 0)) == 3
    assert (store.applied("trade", MAIN, "q"), store.applied("trade", MAIN, "r")) == (1, 0)


def test_nothing_newer_writes_no_version(store, trade_rows):
    store.write("trade", trade_rows({}), MAIN)
    assert upsert_into(store, "trade", trade_rows({"broker_id": 6}), MAIN) == 1
    assert store.versions("trade") == [1]


def test_update_where_keeps_rows_with_unknown_condition(trade_rows):
    rows = trade_rows({"amount": Decimal(-3)}, {"trade_id": 2, "amount": None}, {"trade_id": 3})
    fixed = update_where(rows, F.col("amount") < 0, {"amount": -F.col("amount")})
    assert {r.trade_id: r.amount for r in fixed.collect()} == {1: 3, 2: None, 3: 10}
    assert fixed.schema == rows.schema


def test_rows_are_left_out_by_their_places(spark):
    """Places in several files and blocks, on both sides of a byte and of a block; the way of the join does not matter."""
    rows = spark.range(0, 100_000, 1, 3).select(F.pmod("id", F.lit(2)).alias(upsert.PLACE[0]), F.col("id").alias(upsert.PLACE[1]))
    gone = {k for k in range(100_000) if k % 7 == 0 or k in (1, 8, 32_767, 32_768, 65_535, 65_536, 99_999)}
    marked = upsert.marks(rows.filter(F.col(upsert.PLACE[1]).isin(1, 8, 32_767, 32_768, 65_535, 65_536, 99_999)
                                      | (F.col(upsert.PLACE[1]) % 7 == 0)))
    assert marked.count() == 8
    left = upsert.unmarked(rows, marked)
    assert {r[1] for r in left.collect()} == set(range(100_000)) - gone and left.columns == list(upsert.PLACE)
    assert upsert.unmarked(rows, marked.limit(0)).count() == 100_000


def test_an_upsert_shuffles_neither_table_nor_batch_for_its_joins(store, trade_rows, monkeypatch):
    """Rows are left out where they are."""
    def no_join(*args, **kwargs):
        raise AssertionError("whole rows were joined by key")

    monkeypatch.setattr(upsert, "without", no_join)
    late = datetime(2020, 5, 1)
    store.write("trade", trade_rows({}, {"trade_id": 2}, {"trade_id": 3, "trade_ts": late},
                                    {"trade_id": None}, {"trade_id": 4}), MAIN, layout=MONTHLY)
    upsert_into(store, "trade", trade_rows({"updated_ts": NEW, "broker_id": 6}, {"trade_id": 3, "broker_id": 7, "updated_ts": OLD},
                                           {"trade_id": 2, "broker_id": 8, "updated_ts": NEW}, {"trade_id": 9, "broker_id": 9},
                                           {"trade_id": None, "broker_id": 10}), MAIN)
    found = sorted((r.trade_id or 0, r.broker_id) for r in store.read("trade").collect())
    assert found == [(0, 5), (0, 10), (1, 6), (2, 8), (3, 5), (4, 5), (9, 9)]
