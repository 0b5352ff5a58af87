"""As-of join: each row with the latest earlier row of another table, by ranges, so that hot keys are split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from depotlake.session import workspace


def as_of(left: DataFrame, right: DataFrame, keys: Sequence[str], at: str, known: str,
          values: Sequence[str]) -> DataFrame:
    """``left`` with ``known`` and ``values`` of the row of ``right`` with equal keys and the latest ``known <= at``.

    Rows of both sides are dealt to tasks by ranges of keys, time, side and a hash, and written once with the number of
    their task; each range carries the latest earlier row forward by itself. A key that goes on over several ranges, as a
    hot one does, gets what the ranges before have left: one row for each range that a key enters or leaves, thus
    at most two for each task, which is what is broadcast.

    Rows of ``left`` are all kept, with NULL where nothing is earlier, where a key or the time is NULL. Of rows of
    ``right`` with equal keys and time the one with the greatest values counts; those with a NULL key or time never do.
    """
    spark, keys, values = left.sparkSession, list(keys), list(values)
    usable = F.lit(True)
    for name in (*keys, known):
        usable = usable & F.col(name).isNotNull()
    quotes = right.where(usable).groupBy(*keys, known).agg(
        F.max(F.struct(F.lit(True).alias("_is"), *values)).alias("_values"))
    quotes = quotes.select(*keys, F.col(known).alias("_at"), F.lit(0).alias("_side"),
                           F.struct(F.col(known), *(F.col("_values")[v].alias(v) for v in values)).alias("_quote"))
    rows = left.select(*keys, F.col(at).alias("_at"), F.lit(1).alias("_side"), F.struct(*left.columns).alias("_row"))
    order = [*keys, "_at", "_side", "_tie"]
    tie = F.xxhash64("_row", "_quote")
    path = workspace(spark, "as-of")
    (rows.unionByName(quotes, allowMissingColumns=True).withColumn("_tie", tie).repartitionByRange(*order)
        .withColumn("_task", F.spark_partition_id()).write.parquet(path))
    dealt = spark.read.parquet(path)

    inside = Window.partitionBy("_task", *keys).orderBy("_at", "_side", "_tie")
    filled = dealt.withColumn("_found", F.last("_quote", ignorenulls=True).over(inside)).where("_side = 1")

    # What each range hands on: its latest quote of every key that more than one range holds.
    ends = dealt.groupBy("_task", *keys).agg(
        F.max(F.when(F.col("_quote").isNotNull(), F.struct("_at", "_quote")))["_quote"].alias("_last"))
    of_key = Window.partitionBy(*keys)
    earlier = of_key.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("_ranges", F.count(F.lit(1)).over(of_key)).withColumn(
        "_carried", F.last("_last", ignorenulls=True).over(earlier)).where("_ranges > 1 and _carried is not null").select(
        "_task", *keys, "_carried")
    joined = filled.join(F.broadcast(carried), ["_task", *keys], "left")
    quote = F.coalesce("_found", "_carried")
    return joined.select("_row.*", *(quote[name].alias(name) for name in (known, *values)))
