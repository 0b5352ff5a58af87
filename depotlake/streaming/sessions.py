"""Sessions of a user's events in event time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from depotlake.sources.store import Store


def sessions(events: DataFrame, gap: str, delay: str) -> DataFrame:
    """A user's events no further apart than ``gap``, once no event of the session can come any more.

    Works on streams and on tables. A stream keeps open sessions in its state store until the newest event is
    ``delay`` beyond their end; events that come later than that are dropped. Events without user or time have no session.
    """
    known = events.filter(F.col("user_id").isNotNull() & F.col("ts").isNotNull())
    timed = known.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    grouped = timed.groupBy("user_id", F.session_window("ts", gap).alias("window")).agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("event_type") == "purchase").alias("purchases"),
        F.sum(F.col("value").cast("decimal(18,2)")).cast("decimal(24,2)").alias("total_value"))
    return grouped.select(
        "user_id", F.col("window")["start"].cast("timestamp_ntz").alias("session_start"),
        F.col("window")["end"].cast("timestamp_ntz").alias("session_end"), "events", "purchases", "total_value")


def stream_sessions(store: Store, folder: str, schema: StructType, checkpoint: str, target: str,
                    gap: str, delay: str, files_per_batch: int = 1000) -> None:
    """Append the sessions closed by the event files that arrived in ``folder`` to the Parquet folder ``target``.

    State, watermark and the files already read are in the checkpoint, so a later run goes on where this one ended:
    open sessions continue, and each closed one is written once.
    """
    source = (store.spark.readStream.schema(schema)
              .option("maxFilesPerTrigger", files_per_batch).parquet(folder))
    running = (sessions(source, gap, delay).writeStream.format("parquet").outputMode("append")
               .option("path", target).option("checkpointLocation", checkpoint)
               .trigger(availableNow=True).start())
    running.awaitTermination()
