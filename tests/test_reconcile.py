from __future__ import annotations

from decimal import Decimal

import pytest
from depotlake.operators import reconcile


@pytest.fixture
def sides(spark):
    def build(balance, position):
        left = spark.createDataFrame([(i, s, Decimal(q)) for i, s, q in balance],
                                     "investor_id bigint, security_id bigint, nominal_qty decimal(24,4)")
        right = spark.createDataFrame([(i, s, Decimal(q)) for i, s, q in position],
                                      "investor_id bigint, security_id bigint, net_qty decimal(24,4)")
        return left, right
    return build


PAIRS = [(1, 1, "5"), (1, 2, "-3"), (2, 1, "7.5")]


def test_equal_sides_pass(sides):
    reconcile.reconciliation_gate(*sides(PAIRS, PAIRS))


def test_a_gap_within_the_tolerance_passes(sides):
    reconcile.reconciliation_gate(*sides(PAIRS, [*PAIRS[:2], (2, 1, "7.51")]))


@pytest.mark.parametrize("position, finding", [
    ([], "only_balance"),
    ([*PAIRS, (9, 9, "1")], "only_position"),
    (PAIRS[:2], "only_balance"),
    ([*PAIRS[:2], (2, 1, "7.52")], "mismatched"),
], ids=["empty", "one extra", "one missing", "off"])
def test_the_gate_stops(sides, position, finding):
    with pytest.raises(reconcile.ReconciliationError, match=finding):
        reconcile.reconciliation_gate(*sides(PAIRS, position))


def test_two_empty_sides_are_no_agreement(sides):
    with pytest.raises(reconcile.ReconciliationError):
        reconcile.reconciliation_gate(*sides([], []))


def test_values_and_missing(sides):
    balance, position = sides(PAIRS, [(1, 1, "5"), (1, 2, "3"), (3, 3, "1")])
    row = reconcile.compare_values(balance, position).first()
    assert (row.matched, row.mismatched, row.max_gap, row.verdict) == (2, 1, 6, "DIFFERENT")
    assert reconcile.missing(balance, position, "x").first().pairs == 1
    assert reconcile.missing(position, balance, "x").first().pairs == 1
    totals = reconcile.compare_totals(balance, position).first()
    assert (totals.balance_total, totals.position_total, totals.gap) == (
        Decimal("9.5"), Decimal(9), Decimal("0.5"))


def test_buckets_find_the_pairs_that_differ_and_join_no_others(spark, sides):
    equal = [(i, s, str(i + s)) for i in range(40) for s in range(25)]
    balance, position = sides([*equal, (900, 1, "3"), (901, 1, "1.00"), (902, 1, "8")],
                              [*equal, (900, 1, "4"), (901, 1, "1.01"), (903, 1, "8")])
    rows = {(r["investor_id"], r["status"]) for r in reconcile.compare_by_buckets(balance, position).collect()}
    assert rows == {(900, "different"), (902, "only in balance"), (903, "only in position")}
    unlike = {r["bucket"] for r in reconcile.unlike_buckets(balance, position).collect()}
    assert len(unlike) == 4
    kept = reconcile._bucketed(balance, "nominal_qty", reconcile.RECON_BUCKETS).where(
        reconcile.F.col("bucket").isin(list(unlike))).count()
    assert kept < 10


def test_buckets_of_equal_empty_and_null_sides(sides):
    found = lambda *two: reconcile.compare_by_buckets(*two, buckets=2).collect()
    assert found(*sides(PAIRS, PAIRS)) == [] and found(*sides([], [])) == []
    assert len(found(*sides(PAIRS, []))) == 3
    left, right = sides(PAIRS[:1], PAIRS[:1])
    assert [r["status"] for r in found(left, right.withColumn("net_qty", reconcile.F.lit(None)))] == ["only in balance"]
