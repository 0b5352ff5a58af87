"""File profiles, compaction, retention and orphan reports."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from depotlake.functions.expressions import human_size, mebibytes
from depotlake.operators.upsert import retried
from depotlake.session import MIB
from depotlake.sources.shared_files import file_inventory, parquet_files
from depotlake.sources.store import FILE, FILE_BYTES, MAIN, PART, Store, part_of


class UpkeepError(RuntimeError):
    """Upkeep of at least one table failed."""


def _partition() -> Column:
    """The partition of a part: its path without the version."""
    return F.regexp_replace(F.col("part"), r"^v=[^/]+/?", "")


def live_files(store: Store, table: str, ref: str = MAIN) -> DataFrame:
    """(path, part, partition, length) of the files a ref shows; listing only."""
    manifest = store.manifest(table, store.state(ref)[table])
    base = store.data_folder(table)
    listed = parquet_files(store.spark, [f"{base}/{p['dir']}" for p in manifest["parts"]])
    return (listed.withColumn("part", part_of("path")).withColumn("partition", _partition())
            .select("path", "part", "partition", "length"))


def profile(files: DataFrame) -> DataFrame:
    return files.agg(
        F.count(F.lit(1)).alias("files"),
        mebibytes(F.avg("length")).alias("mean_mb"),
        mebibytes(F.coalesce(F.sum("length"), F.lit(0))).alias("total_mb"),
    )


def per_partition(files: DataFrame) -> DataFrame:
    """Files and bytes of each partition; an unpartitioned table is one group."""
    return files.groupBy("partition").agg(F.count(F.lit(1)).alias("files"),
                                          F.sum("length").alias("bytes"))


def diagnosis(files: DataFrame, min_input_files: int = 2, target_mb: int = 128,
              too_fine: float = 0.05) -> DataFrame:
    """What a compaction would find, and what to do where it cannot help: below ``too_fine``
    of the target the mean file is small because its partition is."""
    groups = per_partition(files)
    enough = (F.col("files") > 1) & (F.col("files") >= min_input_files)
    counted = groups.agg(
        F.count(F.lit(1)).alias("partitions"),
        F.count_if(F.col("files") > 1).alias("with_several_files"),
        F.count_if(enough).alias("candidates"),
        F.round(F.avg("files"), 1).alias("mean_files"),
        F.try_divide(F.sum("bytes"), F.sum("files")).alias("_mean_bytes"),
    )
    advice = (F.when(F.col("candidates") > 0, "compact")
              .when(F.col("_mean_bytes") < too_fine * target_mb * MIB, "partitions are too fine")
              .otherwise("nothing to do"))
    return counted.withColumn("advice", advice).drop("_mean_bytes")


@contextmanager
def advisory_size(spark: SparkSession, size: int) -> Iterator[None]:
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, str(size))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def compact(store: Store, table: str, ref: str = MAIN, min_input_files: int = 2,
            target_mb: int = 128, sort_by: Sequence[str] = ()) -> int | None:
    """Rewrite the partitions with too many files; None when there is none.

    All of them are one Spark job: adaptive execution cuts a large partition
    into several tasks and lets one task write several small ones. When another
    writer changes the table meanwhile, it starts again from what is there then.
    """
    return retried(lambda: _compact(store, table, ref, min_input_files, target_mb, sort_by))


def _compact(store: Store, table: str, ref: str, min_input_files: int, target_mb: int,
             sort_by: Sequence[str]) -> int | None:
    current = store.state(ref)[table]
    groups = per_partition(live_files(store, table, ref))
    chosen = {r["partition"] for r in groups.filter(
        (F.col("files") > 1) & (F.col("files") >= min_input_files)).select("partition").collect()}
    if not chosen:
        return None
    manifest = store.manifest(table, current)
    dropped = [p["dir"] for p in manifest["parts"] if p["dir"].partition("/")[2] in chosen]
    rows = store.read(table, version=current, parts=dropped)
    before = rows.count()
    names = [c["name"] for c in manifest["columns"]]
    with advisory_size(store.spark, target_mb * MIB):
        version = store.write(table, rows.select(*names), ref, "compact", sort_by=sort_by,
                              dropped=dropped, expected=current)
    after = store.manifest(table, version)["rows_written"]
    if before != after:
        raise UpkeepError(f"{table}: compaction read {before} rows and wrote {after}")
    return version


def retention_plan(store: Store, table: str, now: datetime, retain_days: int = 7,
                   retain_last: int = 5) -> DataFrame:
    """Every version and whether it may expire: old enough, not among the last
    ones, and shown by no ref."""
    shown = [v for ref in store.refs() for t, v in store.state(ref).items() if t == table]
    newest = Window.partitionBy("table").orderBy(F.desc("version"))
    log = store.log(table).withColumn("table", F.lit(table))
    cutoff = F.lit((now - timedelta(days=retain_days)).isoformat()).cast("timestamp")
    expire = ((F.col("made_at") < cutoff) & (F.col("rank") > retain_last)
              & ~F.col("version").isin(shown))
    return (log.withColumn("rank", F.row_number().over(newest))
            .select("table", "version", "operation", "made_at", "rank", expire.alias("expire")))


def orphan_files(store: Store, table: str, now: datetime, older_than_days: int = 3) -> DataFrame:
    """Files no ref has ever shown and no running job can still be writing.
    A report only: nothing is deleted."""
    spark = store.spark
    cutoff = F.lit((now - timedelta(days=older_than_days)).isoformat()).cast("timestamp")
    present = parquet_files(spark, [store.data_folder(table)]).withColumn("part", part_of("path"))
    live = spark.createDataFrame([(p,) for p in store.live_parts(table)], "part string")
    return (present.filter(F.col("modificationTime") < cutoff).join(live, "part", "left_anti")
            .select(F.lit(table).alias("table"), "path", "length", "modificationTime"))


def version_summary(store: Store, table: str) -> DataFrame:
    return store.log(table).agg(
        F.count(F.lit(1)).alias("versions"), F.min("made_at").alias("oldest"),
        F.max("made_at").alias("newest")).select(F.lit(table).alias("table"), "*")


def table_sizes(store: Store, ref: str = MAIN) -> DataFrame:
    """Rows, files and bytes of every table a ref shows."""
    frames = []
    for table in sorted(store.state(ref)):
        stored = file_inventory(live_files(store, table, ref))
        rows = store.read(table, ref).agg(F.count(F.lit(1)).alias("n")).scalar()
        frames.append(stored.select(F.lit(table).alias("table"), rows.alias("rows"), "files",
                                    "bytes", human_size(F.col("bytes")).alias("size")))
    union = frames[0]
    for frame in frames[1:]:
        union = union.unionByName(frame)
    return union


def pruning_probe(store: Store, table: str, month: str, ref: str = MAIN) -> DataFrame:
    """Folders, files, bytes and rows behind the whole table and behind one month of it,
    as the scans themselves report where their rows come from."""
    rows = store.read(table, ref, with_part=True, with_file=True)
    frames = []
    for label, scan in (("all", rows), (month, rows.filter(F.col("trade_month") == month))):
        per_file = scan.groupBy(PART, FILE, FILE_BYTES).agg(F.count(F.lit(1)).alias("rows"))
        frames.append(per_file.agg(
            F.count_distinct(PART).alias("folders"), F.count(F.lit(1)).alias("files"),
            F.sum(FILE_BYTES).alias("bytes"), F.sum("rows").alias("rows")).select(
            F.lit(label).alias("scenario"), "*"))
    return frames[0].unionByName(frames[1])


def maintain(store: Store, tables: Sequence[str], upkeep: Callable[[str], object]) -> dict[str, object]:
    """Run ``upkeep`` for every table; one failure stops no other table, but the
    whole run fails when any did."""
    done, failed = {}, defaultdict(str)
    for table in tables:
        try:
            done[table] = upkeep(table)
        except Exception as error:  # noqa: BLE001  every failure is reported below
            failed[table] = str(error)
    if failed:
        raise UpkeepError("; ".join(f"{t}: {e}" for t, e in failed.items()))
    return done
