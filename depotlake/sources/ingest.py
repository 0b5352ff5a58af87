"""Reading operational tables: typed projection, bounds, increments, JDBC."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from depotlake.functions.expressions import at


class EmptySourceError(RuntimeError):
    """The source table has no rows to take bounds from."""


def typed(source: DataFrame, schema: StructType) -> DataFrame:
    """The columns of ``schema``, each cast to its declared type."""
    return source.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields))


def with_lineage(df: DataFrame, ingested_at: datetime, job: str) -> DataFrame:
    """When and by which job a row came in. The stamp is an argument, so that a
    task that is run again writes the same value."""
    return df.withColumns({"_ingest_ts": F.lit(ingested_at), "_ingest_job": F.lit(job)})


def key_bounds(source: DataFrame, key: str, date_column: str) -> DataFrame:
    return source.agg(F.min(key).alias("lo"), F.max(key).alias("hi"),
                      F.count(F.lit(1)).alias("n"),
                      F.min(date_column).alias("first_date"),
                      F.max(date_column).alias("last_date"))


def changed_since(source: DataFrame, since: datetime) -> DataFrame:
    """Rows changed at or after ``since``; the filter reaches the source."""
    return source.filter(F.col("updated_ts") >= at(since))


def high_water_mark(target: DataFrame) -> datetime | None:
    """Where the next increment starts: the newest change already loaded."""
    return target.agg(F.max("updated_ts").alias("mark")).first()["mark"]


def jdbc_table(spark: SparkSession, url: str, table: str,
               options: dict[str, str] | None = None) -> DataFrame:
    """One table, or a parenthesised subquery with an alias, over one connection."""
    return (spark.read.format("jdbc").option("url", url).option("dbtable", table)
            .options(**(options or {})).load())


def jdbc_bounds(spark: SparkSession, url: str, table: str, key: str,
                options: dict[str, str] | None = None) -> tuple[int, int, int]:
    """Smallest key, greatest key and row count, computed by the source."""
    probe = f"(select min({key}) as lo, max({key}) as hi, count(*) as n from {table}) b"
    # Databases differ in the case of unquoted names, so go by position.
    lo, hi, n = jdbc_table(spark, url, probe, options).first()
    if not n:
        raise EmptySourceError(f"{table} is empty")
    return int(lo), int(hi), int(n)


def jdbc_scan_options(url: str, table: str, key: str, lo: int, hi: int, partitions: int = 16,
                      fetch_size: int = 10_000) -> dict[str, str]:
    """Options of a scan in ``partitions`` key ranges. The bounds only set the
    width of a range: the first and the last are open, so no row is left out."""
    return {
        "url": url, "dbtable": table, "partitionColumn": key,
        "lowerBound": str(lo), "upperBound": str(max(hi, lo + 1)),
        "numPartitions": str(partitions), "fetchsize": str(fetch_size),
    }


def jdbc_scan(spark: SparkSession, url: str, table: str, key: str, partitions: int = 16,
              since: datetime | None = None, options: dict[str, str] | None = None) -> DataFrame:
    """Parallel scan of an operational table, optionally only recent changes."""
    lo, hi, _ = jdbc_bounds(spark, url, table, key, options)
    source = (spark.read.format("jdbc").options(**(options or {}))
              .options(**jdbc_scan_options(url, table, key, lo, hi, partitions)).load())
    return source if since is None else changed_since(source, since)
