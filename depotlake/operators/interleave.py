"""A file order that serves lookups by any of several columns: cells of all columns, their bits interleaved."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotlake.functions.expressions import unused
from depotlake.operators.quantiles import exact_quantiles

#: Bits of a column's cell: borders are the quantiles of 1 / 2 ** CELL_BITS, so the driver holds 63 for each column.
CELL_BITS = 6
_FILE = "_metadata.file_path"


def cell_borders(df: DataFrame, column: str) -> list:
    """Values that cut the rows into cells of like size; one value with many rows is a border once."""
    cells = 1 << CELL_BITS
    shares = [str(n / cells) for n in range(1, cells)]
    found = exact_quantiles(df, [], column, shares).select(column).distinct().collect()
    return sorted(row[column] for row in found)


def _cell(column: str, limits: list) -> Column:
    """How many borders are below the value, by halving: a row is compared with six of 63."""
    if not limits:
        return F.lit(0)

    def among(first: int, last: int) -> Column:
        if first == last:
            return F.lit(first)
        middle = (first + last) // 2
        return F.when(F.col(column) > F.lit(limits[middle]), among(middle + 1, last)).otherwise(among(first, middle))

    return among(0, len(limits))


def interleaved_place(borders: dict[str, list]) -> Column:
    """The cells of all columns as one number, whose leading bits take turns between the columns. NULL is the first cell."""
    place = F.lit(0).cast("bigint")
    for turn, (column, limits) in enumerate(borders.items()):
        cell = _cell(column, limits)
        # Bits of a cell move to places that the other columns leave free, in one table look-up.
        spread = [sum(((value >> bit) & 1) << (bit * len(borders) + turn) for bit in range(CELL_BITS))
                  for value in range(len(limits) + 1)]
        place = place.bitwiseOR(F.element_at(F.array(*(F.lit(s).cast("bigint") for s in spread)), cell + 1))
    return place


def interleaved(df: DataFrame, columns: Sequence[str], files: int | None = None) -> DataFrame:
    """``df`` dealt and sorted by its interleaved place, as columns beside it: a sort computes an expression anew for
    both rows of every comparison. A hash deals rows of one place."""
    place, tie = unused(df, "_place"), unused(df, "_tie")
    placed = df.withColumns({place: interleaved_place({column: cell_borders(df, column) for column in columns}),
                             tie: F.xxhash64(*df.columns)})
    order = [place, *columns, tie]
    dealt = placed.repartitionByRange(files, *order) if files else placed.repartitionByRange(*order)
    return dealt.sortWithinPartitions(*order).drop(place, tie)


def write_interleaved(df: DataFrame, path: str, columns: Sequence[str], files: int | None = None) -> None:
    """Write ``df``, a stored table, in files that are ranges of the interleaved order.

    Of N files a lookup by one of k columns has to look into about N to the power of (k - 1) / k, where files sorted by
    one column help its own lookups only. Borders follow the data, so a skewed column has cells of like size; a value
    with a third of all rows is one cell, cut further by the other columns and by a hash. ``files`` is left out but for a fixed
    number of files: adaptive execution then sizes them.
    """
    interleaved(df, columns, files).write.option("compression", "zstd").parquet(path)


def file_ranges(stored: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(file, <column>_low, <column>_high ...)`` of each file, as its footer states them."""
    ends = [end for c in columns for end in (F.min(c).alias(f"{c}_low"), F.max(c).alias(f"{c}_high"))]
    return stored.groupBy(F.col(_FILE).alias("file")).agg(*ends)


def lookup_cost(stored: DataFrame, probes: dict[str, object]) -> DataFrame:
    """``(probe, files, touched)`` for one value of each column: all files, and those whose range holds it."""
    ranges = file_ranges(stored, list(probes))
    counts = [F.struct(F.lit(column).alias("probe"), F.count(F.lit(1)).alias("files"), F.count_if(
        F.lit(value).between(F.col(f"{column}_low"), F.col(f"{column}_high"))).alias("touched"))
        for column, value in probes.items()]
    return ranges.agg(F.array(*counts).alias("probes")).select(F.inline("probes"))
