"""Table shapes and business constants."""

from __future__ import annotations

from pyspark.sql import types as T

BUY, SELL = "BUY", "SELL"
SIDES = (BUY, SELL)

# Tolerances of the amount identity and of the reconciliation.
AMOUNT_TOLERANCE = "0.01"
RECON_TOLERANCE = "0.01"

TRADE_KEY = "trade_id"
PAIR_KEY = ("investor_id", "security_id")

# Newest version of a trade first. The ids break ties between equal stamps.
LATEST_FIRST = ("updated_ts", "security_id", "broker_id")

_LONG, _INT, _TEXT = T.LongType(), T.IntegerType(), T.StringType()
_DATE, _STAMP = T.DateType(), T.TimestampNTZType()
_QTY, _PRICE = T.DecimalType(18, 4), T.DecimalType(18, 6)
_AMOUNT, _FEE = T.DecimalType(20, 4), T.DecimalType(12, 4)


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


TRADE = _struct(
    trade_id=_LONG, investor_id=_LONG, security_id=_LONG, broker_id=_LONG,
    trade_ts=_STAMP, trade_date=_DATE, side=_TEXT,
    qty=_QTY, price=_PRICE, amount=_AMOUNT, commission=_FEE,
    channel=_TEXT, updated_ts=_STAMP,
)

# Attributes a trade receives from its two dimensions.
INVESTOR_ATTRIBUTES = ("investor_type", "country")
SECURITY_ATTRIBUTES = ("short_code", "security_type", "market")

SILVER = _struct(
    trade_id=_LONG, investor_id=_LONG, security_id=_LONG, broker_id=_LONG,
    trade_ts=_STAMP, trade_date=_DATE, trade_hour=_INT, side=_TEXT,
    qty=_QTY, signed_qty=_QTY, price=_PRICE, amount=_AMOUNT, commission=_FEE,
    net_amount=_AMOUNT, channel=_TEXT, investor_type=_TEXT, country=_TEXT,
    short_code=_TEXT, security_type=_TEXT, market=_TEXT, updated_ts=_STAMP,
)

QUARANTINE = _struct(
    trade_id=_LONG, investor_id=_LONG, security_id=_LONG, trade_ts=_STAMP,
    amount=_AMOUNT, qty=_QTY, side=_TEXT, reason=_TEXT,
)

DAILY_KEYS = ("trade_date", "security_id", "short_code", "security_type", "market", "channel")
POSITION_KEYS = ("investor_id", "investor_type", "country",
                 "security_id", "short_code", "security_type")
BROKER_KEYS = ("trade_date", "broker_id", "channel")

REQUIRED = ("trade_id", "investor_id", "security_id", "trade_ts",
            "side", "qty", "price", "amount", "updated_ts")
