"""Exact quantiles and as-of joins against plain Python; files in interleaved order."""

from __future__ import annotations

import math
import random
import re
from collections import defaultdict
from datetime import date, datetime, timedelta
from decimal import Decimal
from fractions import Fraction

import pytest
from conftest import plan_of
from depotlake.operators import asof
from depotlake.operators.asof import as_of
from depotlake.operators.interleave import cell_borders, interleaved, interleaved_place, lookup_cost, write_interleaved
from depotlake.operators.quantiles import exact_quantiles
from depotlake.session import workspace

QUANTILES = ("0", "0.1", "0.25", "0.5", "0.999", "1")


def by_rank(rows):
    groups = defaultdict(list)
    for group, value in rows:
        if value is not None:
            groups[group].append(value)
    return {(g, q): sorted(v)[max(math.ceil(len(v) * Fraction(q)), 1) - 1] for g, v in groups.items() for q in QUANTILES}


def found(df, group, value):
    return {(r[group], str(r["quantile"].normalize() + 0)): r[value] for r in df.collect()}


def test_quantiles_agree_with_ranks(spark):
    dice = random.Random(5)
    rows = [(dice.choice(["hot", "hot", "hot", "b", None]), Decimal(dice.randint(-10**9, 10**9)) / 10_000)
            for _ in range(3000)]
    rows += [("ties", Decimal("7.5"))] * 40 + [("one", Decimal("-0.0001")), ("none", None), ("b", None)]
    df = spark.createDataFrame(rows, "g string, v decimal(20,4)")
    assert found(exact_quantiles(df, ["g"], "v", QUANTILES), "g", "v") == by_rank(rows)


@pytest.mark.parametrize("kind, values", [
    ("bigint", [2**63 - 1, -2**63, 0, -1, 5, 5]), ("int", [-1, 0, 0]), ("bigint", [0]),
    ("date", [date(1969, 12, 31), date(1970, 1, 1), date(2400, 1, 1)]),
], ids=["all bits", "sign only", "zero", "dates"])
def test_kinds_of_values(spark, kind, values):
    rows = [("g", v) for v in values]
    df = spark.createDataFrame(rows, f"g string, v {kind}")
    assert found(exact_quantiles(df, ["g"], "v", QUANTILES), "g", "v") == by_rank(rows)


def test_quantiles_without_groups_without_rows_and_of_texts(spark):
    df = spark.createDataFrame([("a", 3), ("b", 9)], "g string, v int")
    assert [r["v"] for r in exact_quantiles(df, [], "v", ["0.5"]).collect()] == [3]
    assert exact_quantiles(df.limit(0), ["g"], "v", QUANTILES).collect() == []
    with pytest.raises(TypeError, match="g: quantiles take"):
        exact_quantiles(df, [], "g", QUANTILES)


START = datetime(2020, 1, 1)
LEFT, RIGHT = "id int, k string, at timestamp_ntz", "k string, known timestamp_ntz, v int"


def latest(left, right):
    result = {}
    for row, key, at in left:
        fit = [(known, v) for k, known, v in right if None not in (key, at, k, known) and k == key and known <= at]
        best = max(known for known, _ in fit) if fit else None
        result[row] = (best, max(v for known, v in fit if known == best)) if fit else (None, None)
    return result


@pytest.fixture
def many_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_as_of_agrees_with_a_search_also_for_a_hot_key(spark, many_ranges, monkeypatch):
    dice = random.Random(8)
    hour = lambda most: START + timedelta(hours=dice.randint(0, most))
    left = [(n, dice.choice(["hot"] * 8 + ["b", "c", None]), hour(400)) for n in range(600)]
    left += [(600, "hot", None), (601, "d", START), (602, "hot", START - timedelta(days=1))]
    right = [("hot", hour(400), n) for n in range(9)] + [("b", hour(400), n) for n in range(40)]
    right += [("hot", START, 1), ("hot", START, 4), (None, START, 7), ("c", None, 8), ("c", START, 9), ("c", START, 9)]
    path = workspace(spark, "ranges")
    monkeypatch.setattr(asof, "workspace", lambda *_: path)
    df = as_of(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), ["k"], "at", "known", ["v"])
    rows = df.collect()
    assert len(rows) == len(left) and {r["id"]: (r["known"], r["v"]) for r in rows} == latest(left, right)
    ranges = spark.read.parquet(path).where("k = 'hot'").select("_task").distinct().count()
    assert ranges > 1, "the hot key is split over ranges"
    assert df.columns == ["id", "k", "at", "known", "v"]


def test_as_of_with_an_empty_side(spark):
    left = spark.createDataFrame([(1, "a", START)], LEFT)
    right = spark.createDataFrame([("a", START, 5)], RIGHT)
    assert as_of(left, right.limit(0), ["k"], "at", "known", ["v"]).collect()[0]["v"] is None
    assert as_of(left.limit(0), right, ["k"], "at", "known", ["v"]).collect() == []


def test_no_window_sees_a_whole_key(spark):
    left, right = spark.createDataFrame([(1, "a", START)], LEFT), spark.createDataFrame([("a", START, 5)], RIGHT)
    plan = plan_of(as_of(left, right, ["k"], "at", "known", ["v"]))
    assert "SinglePartition" not in plan


def test_interleaved_files_serve_both_columns_also_beside_a_hot_value(spark):
    dice = random.Random(2)
    rows = [(n, 7 if n % 3 == 0 else dice.randint(0, 999), dice.randint(0, 999)) for n in range(4000)] + [(4000, None, None)]
    df = spark.createDataFrame(rows, "id int, a int, b int")
    path = workspace(spark, "interleaved")
    write_interleaved(df, path, ["a", "b"], files=16)
    stored = spark.read.parquet(path)
    assert sorted(map(tuple, stored.collect()), key=lambda r: r[0]) == rows
    cost = {r["probe"]: (r["files"], r["touched"]) for r in lookup_cost(stored, {"a": 600, "b": 600}).collect()}
    assert all(files == 16 and 1 <= touched <= 8 for files, touched in cost.values()), cost
    sizes = [r["count"] for r in stored.groupBy("_metadata.file_path").count().collect()]
    assert max(sizes) < 3 * len(rows) / 16, "the hot value is cut over files"
    assert len(cell_borders(df, "a")) < 63


def test_places_take_turns_between_columns(spark):
    df = spark.createDataFrame([(1, 1), (9, 1), (1, 9), (9, 9), (None, 9)], "a int, b int")
    places = [r["p"] for r in df.select(interleaved_place({"a": [5], "b": [5]}).alias("p")).collect()]
    assert places == [0, 1, 2, 3, 2]
    assert df.select(interleaved_place({"a": []}).alias("p")).distinct().collect()[0]["p"] == 0


def test_interleaved_order_sorts_by_columns_and_not_by_expressions(spark):
    """A sort key is computed again in every comparison: 63 borders for each would take hours of a large table."""
    df = spark.createDataFrame([(n, n % 50, None) for n in range(300)], "id int, a int, b int")
    plan = plan_of(interleaved(df, ["a", "b"], 4)).splitlines()
    sorts = [line for line in plan if re.search(r"\bSort \[|rangepartitioning\(", line)]
    assert sorts and not any(re.search(r"CASE|filter\(|xxhash64|shift", line) for line in sorts), sorts


def test_cells_count_the_borders_below(spark):
    limits = list(range(10, 640, 10))
    df = spark.createDataFrame([(n,) for n in [None, *range(0, 700, 5)]], "a int")
    got = df.select("a", interleaved_place({"a": limits}).alias("p")).collect()
    assert all(r["p"] == sum(limit < r["a"] for limit in limits if r["a"] is not None) for r in got)
