"""Keeping one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from depotlake.model import LATEST_FIRST, TRADE_KEY


def latest_per_key(df: DataFrame, keys: Sequence[str] = (TRADE_KEY,),
                   newest_first: Sequence[str] = LATEST_FIRST) -> DataFrame:
    """The newest row of every key.

    Spark turns ``row_number() = 1`` into a group limit that runs before the
    shuffle as well, so each map task sends one row per key however hot the
    key is. The remaining columns close the ordering: a task that is run again
    on another executor then picks the same row.
    """
    rest = [c for c in df.columns if c not in keys and c not in newest_first]
    order = [F.col(c).desc_nulls_last() for c in (*newest_first, *rest)]
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")
