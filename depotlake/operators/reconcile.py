"""Positions against an independent balance, and the rule table of the suite."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotlake.model import PAIR_KEY, RECON_TOLERANCE


#: Buckets of a comparison by checksums; bounds what is broadcast (one number for each unlike bucket).
RECON_BUCKETS = 65_536


class ReconciliationError(RuntimeError):
    """The published numbers do not agree with their source."""


def _gap():
    return F.abs(F.col("nominal_qty") - F.col("net_qty"))


def _off():
    return _gap() > F.lit(RECON_TOLERANCE).cast("decimal(4,2)")


def count_sides(balance: DataFrame, position: DataFrame) -> DataFrame:
    count = F.count(F.lit(1)).alias("positions")
    return (balance.agg(count).select(F.lit("balance").alias("source"), "positions")
            .unionByName(position.agg(count).select(F.lit("position").alias("source"), "positions")))


def compare_values(balance: DataFrame, position: DataFrame) -> DataFrame:
    """Matched pairs: how many, how many off by more than the tolerance, worst gap."""
    pairs = balance.select(*PAIR_KEY, "nominal_qty").join(
        position.select(*PAIR_KEY, "net_qty"), list(PAIR_KEY))
    counted = pairs.agg(
        F.count(F.lit(1)).alias("matched"),
        F.count_if(_off()).alias("mismatched"),
        F.max(_gap()).cast("decimal(24,4)").alias("max_gap"),
    )
    verdict = F.when(F.col("mismatched") == 0, "RECONCILED").otherwise("DIFFERENT")
    return counted.withColumn("verdict", verdict)


def missing(left: DataFrame, right: DataFrame, label: str) -> DataFrame:
    """Number of pairs of ``left`` that ``right`` does not have."""
    only = left.select(*PAIR_KEY).join(right.select(*PAIR_KEY), list(PAIR_KEY), "left_anti")
    return only.agg(F.count(F.lit(1)).alias("pairs")).select(F.lit(label).alias("status"), "pairs")


def compare_totals(balance: DataFrame, position: DataFrame) -> DataFrame:
    """Both totals over all pairs, matched or not, and their difference."""
    return full_comparison(balance, position).select(
        "balance_total", "position_total",
        (F.col("balance_total") - F.col("position_total")).cast("decimal(24,4)").alias("gap"))


def full_comparison(balance: DataFrame, position: DataFrame) -> DataFrame:
    """Everything the gate needs from one full outer join, as one row."""
    left = balance.select(*PAIR_KEY, "nominal_qty")
    right = position.select(*PAIR_KEY, "net_qty")
    both = left.join(right, list(PAIR_KEY), "full_outer")
    in_balance, in_position = F.col("nominal_qty").isNotNull(), F.col("net_qty").isNotNull()
    zero = F.lit(0).cast("decimal(24,4)")
    return both.agg(
        F.count_if(in_balance).alias("balances"),
        F.count_if(in_position).alias("positions"),
        F.count_if(in_balance & in_position).alias("matched"),
        F.count_if(_off()).alias("mismatched"),
        F.count_if(~in_position).alias("only_balance"),
        F.count_if(~in_balance).alias("only_position"),
        F.coalesce(F.sum("nominal_qty"), zero).cast("decimal(24,4)").alias("balance_total"),
        F.coalesce(F.sum("net_qty"), zero).cast("decimal(24,4)").alias("position_total"),
    )


def reconciliation_gate(balance: DataFrame, position: DataFrame) -> None:
    """Raise unless both sides hold the same pairs with the same quantities.
    Two empty sides do not count as agreement."""
    row = full_comparison(balance, position).first()
    broken = {name: row[name] for name in ("mismatched", "only_balance", "only_position")
              if row[name]}
    if not row["matched"]:
        broken["matched"] = 0
    if broken:
        raise ReconciliationError(f"positions do not reconcile: {broken}")


def _bucketed(side: DataFrame, qty: str, buckets: int) -> DataFrame:
    pair = F.pmod(F.xxhash64(*PAIR_KEY), F.lit(buckets)).alias("bucket")
    return side.select(*PAIR_KEY, F.col(qty).cast("decimal(24,4)").alias(qty), pair)


def _checksums(bucketed: DataFrame, qty: str) -> DataFrame:
    """Count and order-free sum of row hashes, one row for each bucket in use."""
    row = F.xxhash64(*PAIR_KEY, F.coalesce(F.col(qty).cast("string"), F.lit("none"))).cast("decimal(38,0)")
    return bucketed.groupBy("bucket").agg(F.count(F.lit(1)).alias("pairs"), F.sum(row).alias("hashes"))


def unlike_buckets(balance: DataFrame, position: DataFrame, buckets: int = RECON_BUCKETS) -> DataFrame:
    """Buckets of the pair whose rows are not the same on both sides: at most ``buckets`` rows."""
    left = _checksums(_bucketed(balance, "nominal_qty", buckets), "nominal_qty").alias("l")
    right = _checksums(_bucketed(position, "net_qty", buckets), "net_qty").alias("r")
    same = F.col("l.pairs").eqNullSafe(F.col("r.pairs")) & F.col("l.hashes").eqNullSafe(F.col("r.hashes"))
    return left.join(right, "bucket", "full_outer").where(~same).select("bucket")


def compare_by_buckets(balance: DataFrame, position: DataFrame, buckets: int = RECON_BUCKETS) -> DataFrame:
    """The pairs that do not agree: ``(*PAIR_KEY, nominal_qty, net_qty, status)``, as the full comparison finds them.

    Each side is read once for checksums by bucket of the pair, which shuffles partial sums only, and once more for
    the rows of unlike buckets; only those are joined. Pairs are unique on either side. Two unlike buckets of one
    checksum would go unseen, which takes two sums of 64-bit hashes that coincide. Quantities within the tolerance are
    looked at, but not reported; a NULL quantity counts as absent, as in ``full_comparison``.
    """
    unlike = F.broadcast(unlike_buckets(balance, position, buckets))  # no more rows than buckets
    left, right = (_bucketed(side, qty, buckets).join(unlike, "bucket", "left_semi").drop("bucket")
                   for side, qty in ((balance, "nominal_qty"), (position, "net_qty")))
    both = left.join(right, list(PAIR_KEY), "full_outer")
    in_balance, in_position = F.col("nominal_qty").isNotNull(), F.col("net_qty").isNotNull()
    status = (F.when(in_balance & ~in_position, "only in balance")
              .when(in_position & ~in_balance, "only in position").when(_off(), "different"))
    return both.withColumn("status", status).where("status is not null")


def row_accounting(bronze: DataFrame, resolved: DataFrame, key: str = "trade_id") -> DataFrame:
    """Where every bronze row went, followed key by key through one shuffle.

    A key must leave the hop exactly once: its further rows are duplicates, a key
    that does not come out is lost, one that comes out twice is repeated.
    """
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    outcome = F.col("outcome")
    before = bronze.select(key, one.alias("came"), none.alias("valid"), none.alias("held"))
    after = resolved.select(key, none.alias("came"),
                            F.when(outcome == "valid", one).otherwise(none).alias("valid"),
                            F.when(outcome == "quarantined", one).otherwise(none).alias("held"))
    per_key = before.unionByName(after).groupBy(key).agg(
        *(F.sum(n).alias(n) for n in ("came", "valid", "held")))
    left = F.col("valid") + F.col("held")
    row = per_key.agg(
        F.coalesce(F.sum("came"), none).alias("bronze"),
        F.coalesce(F.sum("valid"), none).alias("silver"),
        F.coalesce(F.sum("held"), none).alias("quarantine"),
        F.coalesce(F.sum(F.greatest(F.col("came") - 1, none)), none).alias("duplicates"),
        F.count_if((F.col("came") > 0) & (left == 0)).alias("lost"),
        F.count_if((left > 1) | ((F.col("came") == 0) & (left > 0))).alias("repeated"),
    )
    explained = F.col("silver") + F.col("quarantine") + F.col("duplicates")
    whole = (F.col("bronze") == explained) & (F.col("lost") == 0) & (F.col("repeated") == 0)
    return row.withColumn("balanced", whole)


def check(number: int, name: str, expected, found) -> tuple:
    return number, name, str(expected), str(found), expected == found


CHECK_SCHEMA = "check_no INT, check_name STRING, expected STRING, found STRING, passed BOOLEAN"


def require_passed(checks: DataFrame) -> None:
    """Fail only after every check has run; the message lists each failure."""
    failed = checks.filter(~F.col("passed")).orderBy("check_no").collect()
    if failed:
        lines = (f"{r.check_no} {r.check_name}: expected {r.expected}, found {r.found}"
                 for r in failed)
        raise ReconciliationError("; ".join(lines))
