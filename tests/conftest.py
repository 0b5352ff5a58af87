from __future__ import annotations

import sys
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parents[1]), str(Path(__file__).parent)]

from depotlake.model import SILVER, TRADE  # noqa: E402
from depotlake.session import build_session, workspace  # noqa: E402
from depotlake.sources.store import Store  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[8]", conf={
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "6g",
        "spark.sql.sources.parallelPartitionDiscovery.threshold": "1000",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def store(spark):
    return Store(spark, workspace(spark, "test"))


_DEFAULTS = dict(
    trade_id=1, investor_id=10, security_id=100, broker_id=5,
    trade_ts=datetime(2020, 1, 15, 10), trade_date=date(2020, 1, 15), side="BUY",
    qty=Decimal("2.0000"), price=Decimal("5.000000"), amount=Decimal("10.0000"),
    commission=Decimal("0.1000"), channel="WEB", updated_ts=datetime(2020, 1, 15, 10),
    trade_hour=10, signed_qty=Decimal("2.0000"), net_amount=Decimal("9.9000"),
    investor_type="RETAIL", country="X", short_code="S", security_type="STOCK", market="M",
)


@pytest.fixture
def trade_rows(spark):
    """Frames of trades from the columns that matter; the others have defaults."""
    def build(*rows, schema=TRADE):
        data = [tuple({**_DEFAULTS, **row}[name] for name in schema.names) for row in rows]
        return spark.createDataFrame(data, schema)
    return build


@pytest.fixture
def silver_rows(trade_rows):
    return lambda *rows: trade_rows(*rows, schema=SILVER)


@pytest.fixture
def investors(spark):
    return spark.createDataFrame([(10, "RETAIL", "X", True), (11, "FUND", "Y", False)],
                                 "investor_id bigint, investor_type string, country string, "
                                 "active boolean")


@pytest.fixture
def securities(spark):
    return spark.createDataFrame([(100, "AAA", "STOCK", "MAIN"), (101, "BBB", "BOND", "DEBT")],
                                 "security_id bigint, short_code string, security_type string, "
                                 "market string")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
