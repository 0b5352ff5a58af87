"""Parquet sinks with a declared layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOOM_FALSE_POSITIVES = 0.01


def write_clustered(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                    sort_by: Sequence[str] = (), bloom_on: Sequence[str] = (),
                    mode: str = "errorifexists", options: dict[str, str] | None = None,
                    by_range: bool = False, dealt: bool = False, grouped: bool = False) -> None:
    """Write ``df`` in files of about the advisory size, sorted inside.

    The rebalance hint brings the rows of a directory together without one task
    per directory: adaptive execution splits a directory that is too large for a
    task and merges those that are small. Sorting narrows the min/max statistics
    of the row groups, Bloom filters serve lookups on unsorted columns.

    ``by_range`` gives each file a range of its own, so that a lookup skips whole
    files. It samples the input first: for copies of stored tables, not for
    frames that are expensive to compute twice. ``dealt`` rows are in few tasks for each
    directory already, such as those of a stored table with the same layout; they stay there. So do ``grouped`` rows,
    groups of a mart that were dealt by their directory before they were added up.
    """
    if dealt or grouped:
        out = df
    elif by_range:
        out = df.repartitionByRange(*partition_by, *sort_by)
    else:
        out = df.hint("rebalance", *(F.col(c) for c in partition_by))
    if partition_by or sort_by:
        out = out.sortWithinPartitions(*partition_by, *sort_by)
    writer = out.write.mode(mode).option("compression", "zstd").options(**(options or {}))
    for name in bloom_on:
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true").option(
            f"parquet.bloom.filter.fpp#{name}", str(BLOOM_FALSE_POSITIVES))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str],
                         sort_by: Sequence[str] = ()) -> None:
    """Replace only the partitions that ``df`` has rows for.

    Right for an increment. A full load must use ``full_refresh``, or partitions
    that have vanished from the source would stay.
    """
    write_clustered(df, path, partition_by, sort_by, mode="overwrite",
                    options={"partitionOverwriteMode": "dynamic"})


def full_refresh(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                 sort_by: Sequence[str] = ()) -> None:
    """Replace everything, also by an empty result."""
    write_clustered(df, path, partition_by, sort_by, mode="overwrite",
                    options={"partitionOverwriteMode": "static"})


def append(df: DataFrame, path: str, partition_by: Sequence[str] = (),
           sort_by: Sequence[str] = ()) -> None:
    write_clustered(df, path, partition_by, sort_by, mode="append")
