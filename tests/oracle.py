"""Running a registered query and its SQL on the same tables."""

from __future__ import annotations

import glob
import os
from decimal import Decimal

import duckdb
import pyarrow as pa


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _kind(kind: pa.DataType) -> str:
    if pa.types.is_timestamp(kind):
        return "timestamp" if kind.tz is None else "timestamp with zone"
    if pa.types.is_string(kind) or pa.types.is_large_string(kind):
        return "string"
    return str(kind).replace("decimal128", "decimal")


def _cell(value):
    if isinstance(value, float):
        return repr(round(value, 9))
    if isinstance(value, Decimal):
        return str(value.normalize() + 0)
    return str(value)


def shape(table: pa.Table) -> dict[str, str]:
    return {name: _kind(table.schema.field(name).type) for name in sorted(table.schema.names)}


def rows(table: pa.Table) -> list[tuple[str, ...]]:
    columns = [[_cell(v) for v in table.column(n).to_pylist()] for n in sorted(table.schema.names)]
    return sorted(zip(*columns))


def difference(spark_table: pa.Table, oracle_table: pa.Table) -> str | None:
    """None when schema and rows agree, else what differs first."""
    if shape(spark_table) != shape(oracle_table):
        ours, theirs = shape(spark_table), shape(oracle_table)
        return f"schema: {set(ours.items()) ^ set(theirs.items())}"
    left, right = rows(spark_table), rows(oracle_table)
    if len(left) != len(right):
        return f"{len(left)} rows instead of {len(right)}"
    for a, b in zip(left, right):
        if a != b:
            return f"{a} instead of {b}"
    return None
