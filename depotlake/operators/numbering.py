"""Consecutive numbers over a whole table in a stated order, without one task that sees all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotlake.session import workspace

#: Bits of ``monotonically_increasing_id`` that count the rows of one partition.
ROW_BITS = 33


def numbered(df: DataFrame, order: Sequence[Column], name: str = "number", tie: str | None = None) -> DataFrame:
    """``df`` with the place of each row, from 1, in ``order``; rows that tie are numbered by ``tie`` or a hash.

    Rows are dealt to tasks by ranges of the order and sorted there. Each task counts its own rows; a task's offset
    is the sum of the counts before it, one number for each task. The ranges come from a sample, so the dealt rows are
    written once and read again: a repeated task could otherwise see other ranges.
    """
    keys = [*order, F.col(tie) if tie else F.xxhash64(*df.columns)]
    spark, place = df.sparkSession, "_place"
    path = workspace(spark, "numbered")
    dealt = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    dealt.withColumn(place, F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path).withColumn("_task", F.shiftright(place, ROW_BITS))
    counts = {r["_task"]: r["n"] for r in rows.groupBy("_task").agg(F.count(F.lit(1)).alias("n")).collect()}
    offsets, before = [], 0
    for task in sorted(counts):
        offsets.append((task, before))
        before += counts[task]
    known = spark.createDataFrame(offsets, "_task bigint, _before bigint")
    local = F.col(place).bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    # One row for each task that wrote rows: as many as the write had tasks.
    return rows.join(F.broadcast(known), "_task").select(
        *df.columns, (F.col("_before") + local + 1).alias(name))
