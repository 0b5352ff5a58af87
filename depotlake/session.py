"""Session settings and the shared working folder."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

MIB = 1024 * 1024
ADVISORY_PARTITION_BYTES = 128 * MIB

# Per-session settings every job relies on. AQE sizes, coalesces and splits
# the shuffles; the time zone is pinned because months and hours depend on it.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(ADVISORY_PARTITION_BYTES),
    # Some years of month folders are listed by the driver, which beats a job of one task per folder.
    "spark.sql.sources.parallelPartitionDiscovery.threshold": "256",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.files.maxPartitionBytes": str(ADVISORY_PARTITION_BYTES),
}


def shuffle_partitions_for(input_bytes: int, cores: int) -> int:
    """Initial reducer count for a job that shuffles ``input_bytes``.

    AQE merges small reducers but cannot make more than it started with, so the
    start is sized from the data: one reducer per advisory partition, and at least
    one per core.
    """
    return max(cores, -(-int(input_bytes) // ADVISORY_PARTITION_BYTES))


def build_session(app: str, master: str | None = None, input_bytes: int | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """The session used by jobs, tests and the benchmark."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if input_bytes is not None:
        cores = spark.sparkContext.defaultParallelism
        spark.conf.set("spark.sql.shuffle.partitions",
                       str(shuffle_partitions_for(input_bytes, cores)))
    return spark


@functools.cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="depotlake-")


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it.

    ``spark.checkpoint.dir`` wins. Only a local session, where driver and
    executors are one process, may fall back to a fresh temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_root()


def workspace(spark: SparkSession, purpose: str) -> str:
    """A new, unused path below the shared folder; nothing is created yet."""
    return f"{shared_root(spark)}/depotlake/{purpose}-{uuid.uuid4().hex[:12]}"


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes inside go when the write ends, not when the driver next collects its garbage.

    For writes only: nothing reads their shuffles again. Threads share the setting, so it goes around all of them.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
