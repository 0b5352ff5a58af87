from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from conftest import plan_of
from depotlake.operators import quality, silver
from depotlake.operators.dedup import latest_per_key
from depotlake.operators.reconcile import row_accounting
from pyspark.sql import functions as F


@pytest.mark.parametrize("column", ["qty", "amount", "side", "price", "investor_id"])
def test_a_missing_value_never_loses_the_row(trade_rows, investors, securities, column):
    resolved = silver.resolve(trade_rows({}, {"trade_id": 2, column: None}), investors, securities)
    valid, quarantined = silver.valid_only(resolved), silver.quarantined_only(resolved)
    assert valid.count() + quarantined.count() == 2
    expected = {"qty": "quantity missing", "amount": "amount missing", "side": "side missing",
                "investor_id": "no matching investor"}.get(column)
    assert [r.reason for r in quarantined.collect()] == ([expected] if expected else [])


def test_all_reasons_are_listed(trade_rows, investors, securities):
    rows = trade_rows({"investor_id": 99, "security_id": 999, "amount": Decimal(-1),
                       "qty": Decimal(0), "side": "X"})
    reason = silver.quarantined_only(silver.resolve(rows, investors, securities)).first().reason
    assert reason == ("no matching investor; no matching security; amount not positive; "
                      "quantity not positive; side unknown")


def test_an_unknown_side_is_not_a_sale(trade_rows, investors, securities):
    rows = trade_rows(*({"trade_id": i, "side": s} for i, s in enumerate(["BUY", "SELL", "X", None])))
    signed = {r.side: r.signed_qty for r in silver.enrich(rows, investors, securities).collect()}
    assert signed == {"BUY": 2, "SELL": -2, "X": None, None: None}


def test_newest_version_wins_and_ties_break_by_ids(trade_rows):
    rows = trade_rows({"broker_id": 1}, {"broker_id": 2}, {"broker_id": 3, "security_id": 99},
                      {"broker_id": 9, "updated_ts": datetime(2019, 1, 1)},
                      {"broker_id": 8, "updated_ts": None})
    assert [r.broker_id for r in latest_per_key(rows).collect()] == [2]


def test_dedup_does_not_depend_on_row_order(trade_rows):
    variants = [{"channel": c, "qty": Decimal(q)} for c in "abc" for q in (1, 2, 3)]
    picked = {latest_per_key(trade_rows(*order)).first()
              for order in (variants, variants[::-1], variants[4:] + variants[:4])}
    assert len(picked) == 1


def test_a_hot_key_is_limited_before_the_shuffle(trade_rows):
    plan = plan_of(latest_per_key(trade_rows({}, {})))
    below_shuffle = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in below_shuffle and "Partial" in below_shuffle


def test_row_accounting_counts_duplicates_and_rows_without_key(trade_rows, investors, securities):
    rows = trade_rows({}, {}, {"trade_id": 2, "qty": Decimal(-1)}, {"trade_id": None},
                      {"trade_id": None})
    resolved = silver.resolve(rows, investors, securities)
    row = row_accounting(rows, resolved).first()
    assert (row.bronze, row.silver, row.quarantine, row.duplicates) == (5, 2, 1, 2)
    assert row.balanced
    lost = resolved.filter(F.col("outcome") == "valid")
    assert not row_accounting(rows, lost).first().balanced


def test_quality_report_names_every_broken_rule(trade_rows):
    rows = trade_rows({}, {}, {"trade_id": 3, "amount": Decimal(-10)}, {"trade_id": 4, "qty": None},
                      {"trade_id": 5, "side": "X"}, {"trade_id": 6, "price": None})
    assert quality.findings(quality.quality_report(rows)) == {
        "trade_id repeated": 1, "amount differs from qty * price": 1, "amount not positive": 1,
        "qty is null": 1, "price is null": 1, "side unknown": 1}


def test_an_empty_table_is_a_finding(trade_rows):
    assert quality.findings(quality.quality_report(trade_rows())) == {"table is empty": 1}


def test_clean_rows_pass(trade_rows):
    quality.require_clean(quality.quality_report(trade_rows({}, {"trade_id": 2})), "t")
    with pytest.raises(quality.QualityError, match="trade_id repeated"):
        quality.require_clean(quality.quality_report(trade_rows({}, {})), "t")
