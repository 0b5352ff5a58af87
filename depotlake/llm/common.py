"""Helpers that several operators share."""

from __future__ import annotations

import functools
import io
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import depotlake
from depotlake.session import workspace
from depotlake.sources.shared_files import SharedFiles

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers, once for each application.

    Functions that run there are named by their module, which a worker on another machine may not have.
    """
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    root, content = Path(depotlake.__file__).parent, io.BytesIO()
    with zipfile.ZipFile(content, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, file.relative_to(root.parent))
    path = f"{workspace(spark, 'code')}/depotlake.zip"
    SharedFiles(spark).put(path, content.getvalue())
    spark.sparkContext.addPyFile(path)
    _shipped.add(application)


def shipped(function: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``function`` of a session and more, run after ``ship``."""
    @functools.wraps(function)
    def run(spark: SparkSession, *args, **kwargs) -> DataFrame:
        ship(spark)
        return function(spark, *args, **kwargs)
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (names ignore case)."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def settled(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read again, which cuts its lineage.

    The files of its shuffles go once it is written, as nothing reads them again.
    """
    spark = df.sparkSession
    path, before = workspace(spark, purpose), spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.settled_path = path
    return out


def removed(*frames: DataFrame) -> None:
    """Remove the folders of ``settled`` frames that nothing will read again."""
    for frame in frames:
        SharedFiles(frame.sparkSession).remove(frame.settled_path)


def remainder(id_column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; NULL for a NULL id."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % modulus


def held_out(id_column: str, modulus: int, rest: int) -> Column:
    """Whether a row is kept from learning; a row without id is neither learnt from nor held out."""
    return F.coalesce(remainder(id_column, modulus) == rest, F.lit(False))


def learnable(id_column: str, modulus: int, rest: int) -> Column:
    return F.coalesce(remainder(id_column, modulus) != rest, F.lit(False))


def bounded_sample(df: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """About ``rows`` rows at most, chosen by a hash of ``keys``; all of them when there are fewer.

    One count decides the share, so no row is sorted, shuffled or sent to the driver.
    """
    total = df.count()
    if total <= rows:
        return df
    limit = int(rows / total * (1 << 30))
    return df.where(F.pmod(F.xxhash64(*keys), F.lit(1 << 30)) < limit)
