"""Data-quality rules, counted in one pass over the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotlake.functions.expressions import amount_gap
from depotlake.model import AMOUNT_TOLERANCE, REQUIRED, SIDES, TRADE_KEY


class QualityError(RuntimeError):
    """A blocking rule failed."""


def null_rules(columns: Sequence[str] = REQUIRED) -> dict[str, Column]:
    return {f"{name} is null": F.col(name).isNull() for name in columns}


def business_rules() -> dict[str, Column]:
    return {
        "amount differs from qty * price": amount_gap() > F.lit(AMOUNT_TOLERANCE).cast("decimal(4,2)"),
        "amount not positive": F.col("amount") <= 0,
        "qty not positive": F.col("qty") <= 0,
        "side unknown": ~F.col("side").isin(*SIDES),
    }


def _listed(counts: DataFrame, names: Sequence[str]) -> DataFrame:
    """(rule, violations) from one row with a column for each rule."""
    pairs = F.array(*(F.struct(F.lit(name).alias("rule"), F.col(f"r{i}").alias("violations"))
                      for i, name in enumerate(names)))
    return counts.select(F.inline(pairs))


def violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, violations) for row rules, all counted in one aggregate."""
    return _listed(df.agg(*(F.count_if(test).alias(f"r{i}") for i, test in enumerate(rules.values()))), list(rules))


def duplicate_keys(df: DataFrame, keys: Sequence[str] = (TRADE_KEY,)) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def quality_report(df: DataFrame, keys: Sequence[str] | None = (TRADE_KEY,),
                   rules: dict[str, Column] | None = None) -> DataFrame:
    """Violations per rule; a rule without findings is listed with zero.

    One pass: rows are counted and tested by key, which map tasks combine before the
    shuffle, and the keys then tell how many rows there are and how many keys occur
    more than once. Without ``keys`` nothing is shuffled.
    """
    rules = {**null_rules(), **business_rules()} if rules is None else rules
    none = F.lit(0).cast("bigint")
    tests = [F.count_if(test).alias(f"t{i}") for i, test in enumerate(rules.values())]
    tested = (df.groupBy(*keys) if keys else df.groupBy()).agg(F.count(F.lit(1)).alias("n"), *tests)
    counts = [(F.coalesce(F.sum("n"), none) == 0).cast("bigint")]
    names = ["table is empty"]
    if keys:
        counts.append(F.count_if(F.col("n") > 1))
        names.append(f"{', '.join(keys)} repeated")
    counts += [F.coalesce(F.sum(f"t{i}"), none) for i in range(len(rules))]
    names += list(rules)
    return _listed(tested.agg(*(count.alias(f"r{i}") for i, count in enumerate(counts))), names)


def findings(report: DataFrame) -> dict[str, int]:
    """The broken rules on the driver: at most one small row per rule."""
    return {r["rule"]: r["violations"] for r in report.filter("violations > 0").collect()}


def require_clean(report: DataFrame, what: str) -> None:
    broken = findings(report)
    if broken:
        raise QualityError(f"{what}: " + "; ".join(f"{k} ({v})" for k, v in broken.items()))
