"""Every registered query against the SQL that states its result."""

from __future__ import annotations

import __spark_entry__ as contract
import oracle
import pytest

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(FOLDER)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() == 5


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, duck, name):
    ours = QUERIES[name](spark, FOLDER).toArrow()
    theirs = duck.sql(ORACLES[name]).to_arrow_table()
    assert oracle.difference(ours, theirs) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_has_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0
