"""Bronze to silver: newest version, dimensions, derived columns, validity."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotlake.functions.expressions import holds, net_amount, signed_qty
from depotlake.model import QUARANTINE, SIDES, SILVER
from depotlake.operators.dedup import latest_per_key
from depotlake.operators.joins import BROADCAST_LIMIT_BYTES, join_dimension

VALID, QUARANTINED = "valid", "quarantined"
QUARANTINED_AT = "quarantined_at"


def enrich(trades: DataFrame, investors: DataFrame, securities: DataFrame,
           broadcast_limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Trades with both dimensions attached; unmatched trades stay, with NULLs."""
    investors = investors.select("investor_id", "investor_type", "country")
    securities = securities.select("security_id", "short_code", "security_type", "market")
    joined = join_dimension(trades, investors, "investor_id", limit=broadcast_limit)
    joined = join_dimension(joined, securities, "security_id", limit=broadcast_limit)
    return joined.withColumns({
        "signed_qty": signed_qty(),
        "net_amount": net_amount(),
        "trade_hour": F.hour("trade_ts"),
    }).select(*SILVER.names)


def rejection_reasons() -> dict[str, Column]:
    """Why a trade is not valid. Each predicate names the NULL case by itself,
    so that a missing value is a reason and never an unknown."""
    side = F.col("side")
    return {
        "no matching investor": F.col("investor_type").isNull(),
        "no matching security": F.col("security_type").isNull(),
        "amount missing": F.col("amount").isNull(),
        "amount not positive": F.col("amount") <= 0,
        "quantity missing": F.col("qty").isNull(),
        "quantity not positive": F.col("qty") <= 0,
        "side missing": side.isNull(),
        "side unknown": ~side.isin(*SIDES),
    }


def with_outcome(enriched: DataFrame) -> DataFrame:
    """Adds ``outcome`` and ``reason``; every row gets exactly one outcome."""
    reason = F.concat_ws("; ", *(F.when(holds(test), F.lit(text))
                                 for text, test in rejection_reasons().items()))
    outcome = F.when(F.col("reason") == "", VALID).otherwise(QUARANTINED)
    return enriched.withColumn("reason", reason).withColumn("outcome", outcome)


def stamped(resolved: DataFrame, now: datetime) -> DataFrame:
    """Adds when a row was rejected; valid rows have no stamp."""
    return resolved.withColumn(QUARANTINED_AT, F.when(F.col("outcome") == QUARANTINED, F.lit(now)))


def valid_only(resolved: DataFrame) -> DataFrame:
    return resolved.filter(F.col("outcome") == VALID).select(*SILVER.names)


def quarantined_only(resolved: DataFrame) -> DataFrame:
    return resolved.filter(F.col("outcome") == QUARANTINED).select(*QUARANTINE.names)


def resolve(bronze: DataFrame, investors: DataFrame, securities: DataFrame) -> DataFrame:
    """The whole hop as one lineage, so that one write serves both outcomes."""
    return with_outcome(enrich(latest_per_key(bronze), investors, securities))
