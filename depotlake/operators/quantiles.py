"""Exact discrete quantiles of groups of any size, without sorting and without a group in one task."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, IntegralType

from depotlake.operators.joins import broadcast_if_small
from depotlake.session import workspace

#: Bits of the value that one round decides: at most so many counts (as a power of two) for each place searched.
ROUND_BITS = 10
_EPOCH = "1970-01-01"


def _as_long(df: DataFrame, value: str) -> tuple[Column, Column]:
    """``value`` as a long in the same order, and the way back from the column ``_long``."""
    kind = df.schema[value].dataType
    if isinstance(kind, DecimalType):
        whole = (F.col(value).cast(DecimalType(38, kind.scale)) * F.lit(10 ** kind.scale)).cast("bigint")
        back = (F.col("_long").cast(DecimalType(38 - kind.scale, 0)) / F.lit(Decimal(10) ** kind.scale)).cast(kind)
        return whole, back
    if isinstance(kind, DateType):
        start = F.lit(_EPOCH).cast("date")
        return F.date_diff(F.col(value), start).cast("bigint"), F.date_add(start, F.col("_long").cast("int"))
    if isinstance(kind, IntegralType):
        return F.col(value).cast("bigint"), F.col("_long").cast(kind)
    raise TypeError(f"{value}: quantiles take whole numbers, decimals and dates, not {kind.simpleString()}")


def exact_quantiles(df: DataFrame, groups: Sequence[str], value: str,
                    quantiles: Sequence[str]) -> DataFrame:
    """``(*groups, quantile, value)``: for each group and quantile q the least value that at least q of the values
    do not exceed, as ``percentile_disc`` defines it.

    ``quantiles`` are decimal texts between 0 and 1, so ranks are exact. The leading bits of the wanted values are
    found round by round: a histogram of the next bits, taken of the rows that agree with what is known so far, tells
    in which bar a rank falls. A round shuffles map-side counts only, at most ``2 ** ROUND_BITS`` for each place,
    whatever the size of a group. Group columns and values are written once, so that all rounds see the same rows.

    NULL values do not count, a group without values has no row, NULL is a group like any other. A decimal whose
    digits do not fit 63 bits raises.
    """
    spark, groups = df.sparkSession, list(groups)
    to_long, back = _as_long(df, value)
    path = workspace(spark, "quantiles")
    df.where(F.col(value).isNotNull()).select(*groups, to_long.alias("_long")).write.parquet(f"{path}/rows")
    rows = spark.read.parquet(f"{path}/rows")

    ranges = rows.agg(F.min("_long").alias("low"), F.max("_long").alias("high")).first()
    widest = max((ranges["low"] or 0), (ranges["high"] or 0), -(ranges["low"] or 0) - 1, -(ranges["high"] or 0) - 1)
    shift = -(-widest.bit_length() // ROUND_BITS) * ROUND_BITS

    asked = F.explode(F.array(*(F.lit(q).cast("decimal(9,8)") for q in quantiles)))
    rank = F.greatest(F.ceil(F.col("_n") * F.col("quantile")).cast("bigint"), F.lit(1))
    # Beyond all bits only the sign is left: -1 or 0. Starting one round above it, every value has the prefix 0 or -1.
    counted = rows.groupBy(*groups, F.shiftright("_long", min(shift, 63)).alias("_next")).agg(
        F.count(F.lit(1)).alias("_bar"))
    totals = counted.groupBy(*groups).agg(F.sum("_bar").alias("_n"))
    places = totals.select(*groups, asked.alias("quantile"), "_n").select(
        *groups, "quantile", rank.alias("_rank"))
    places = _narrowed(places, counted, groups, f"{path}/places-{shift}")
    while shift > 0:
        known, shift = min(shift, 63), shift - ROUND_BITS
        wanted = places.select(*groups, "_prefix").distinct()
        prefixed = rows.withColumn("_prefix", F.shiftright("_long", known))
        counted = _null_safe(prefixed, broadcast_if_small(wanted), [*groups, "_prefix"], "left_semi").groupBy(
            *groups, "_prefix", F.shiftright("_long", shift).alias("_next")).agg(F.count(F.lit(1)).alias("_bar"))
        places = _narrowed(places, counted, [*groups, "_prefix"], f"{path}/places-{shift}", groups)
    return places.withColumn("_long", F.col("_prefix")).select(*groups, "quantile", back.alias(value))


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    left, right = left.alias("l"), right.alias("r")
    same = F.lit(True)
    for key in keys:
        same = same & F.col(f"l.{key}").eqNullSafe(F.col(f"r.{key}"))
    return left.join(right, same, how)


def _narrowed(places: DataFrame, counted: DataFrame, keys: list[str], path: str,
              groups: list[str] | None = None) -> DataFrame:
    """Places with the bar that holds their rank as prefix, and the rank inside it; written and read again."""
    groups = keys if groups is None else groups
    before = Window.partitionBy(*keys).orderBy("_next")
    bars = counted.withColumn("_upto", F.sum("_bar").over(before)).withColumn("_from", F.col("_upto") - F.col("_bar"))
    found = _null_safe(places, bars, keys, "inner").where("_rank > _from and _rank <= _upto").select(
        *(F.col(f"l.{name}") for name in groups), "quantile",
        (F.col("_rank") - F.col("_from")).alias("_rank"), F.col("_next").alias("_prefix"))
    found.write.parquet(path)
    return places.sparkSession.read.parquet(path)
