"""Joins whose broadcast side has a measured size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

from depotlake.session import MIB

BROADCAST_LIMIT_BYTES = 64 * MIB

# Room one row takes besides its text: row header plus a slot per column.
_ROW_BYTES, _SLOT_BYTES = 16, 16


def measured_bytes(df: DataFrame) -> int:
    """Size of ``df`` once it is held in memory, from one column-pruned pass."""
    nested = (ArrayType, MapType, StructType)
    texts = []
    for field in df.schema.fields:
        if isinstance(field.dataType, nested):
            texts.append(F.octet_length(F.to_json(F.struct(F.col(field.name)))))
        elif isinstance(field.dataType, (StringType, BinaryType)):
            texts.append(F.octet_length(F.col(field.name)))
    variable = sum((F.coalesce(t, F.lit(0)) for t in texts), F.lit(0).cast("bigint"))
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(variable).alias("text")).first()
    return row["n"] * (_ROW_BYTES + _SLOT_BYTES * len(df.columns)) + (row["text"] or 0)


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast when its measured size is within ``limit``.

    Beyond it the frame comes back unmarked: the join then shuffles both sides
    and adaptive execution splits the partitions of hot keys.
    """
    return F.broadcast(df) if measured_bytes(df) <= limit else df


def join_dimension(facts: DataFrame, dimension: DataFrame, on: str | Sequence[str],
                   how: str = "left", limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Facts with the attributes of a dimension that is unique on ``on``."""
    return facts.join(broadcast_if_small(dimension, limit), on, how)
