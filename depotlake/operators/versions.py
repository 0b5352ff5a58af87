"""Comparing versions of a stored table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from depotlake.model import TRADE_KEY
from depotlake.operators.joins import BROADCAST_LIMIT_BYTES
from depotlake.operators.upsert import MARK_ROWS, PLACE, at_marks, marks, placed
from depotlake.sources.store import Store

ADDED, DELETED, UPDATED = "added", "deleted", "updated"


def version_changes(store: Store, table: str, before: int, after: int,
                    key: str = TRADE_KEY) -> DataFrame:
    """The change feed from one version to another: ``change, copies`` and the columns both versions have.

    Parts that both versions list hold the same rows and are not read, so the cost follows what was rewritten. What
    is left of the rows of both sides, taken from each other as multisets, has changed: an updated key shows its new
    values, a deleted one its last. Rows without a key are never updated, only added and deleted; ``copies`` tells how
    many equal ones. Columns that only one version has do not count.

    Rows of a key are known by a 64-bit hash: a key whose old and new row share it, which is improbable, would go unseen.
    Only keys, hashes and places are shuffled; the rows that changed are then read by their places.
    """
    sides = _rewritten(store, table, before, after)
    places, rows = _changed_places(sides, key), reduce(DataFrame.unionByName, sides)
    names = [c for c in rows.columns if c not in PLACE]
    marked = marks(places.select(*PLACE))
    # Counted from file footers: no more bitmaps than the files have blocks.
    bitmaps = rows.count() // MARK_ROWS + len(rows.inputFiles())
    few = bitmaps * MARK_ROWS // 8 <= BROADCAST_LIMIT_BYTES
    changed = at_marks(rows, F.broadcast(marked) if few else marked)
    return changed.join(places, list(PLACE)).select("change", "copies", *names)


def _rewritten(store: Store, table: str, before: int, after: int) -> list[DataFrame]:
    """The rows of the parts that only one of the versions lists, with their places: of ``before``, of ``after``."""
    manifests = store.manifest(table, before), store.manifest(table, after)
    old, new = ({p["dir"] for p in m["parts"]} for m in manifests)
    names = [c["name"] for c in manifests[0]["columns"]
             if c["name"] in {d["name"] for d in manifests[1]["columns"]}]
    return [placed(store.read(table, version=version, parts=sorted(parts), with_file=True)).select(*names, *PLACE)
            for version, parts in ((before, old - new), (after, new - old))]


def _changed_places(sides: list[DataFrame], key: str) -> DataFrame:
    """``change, copies`` and the place of one of the rows that are more on one side than on the other, for each key,
    and the place of what is there now where a key was updated."""
    names = [c for c in sides[0].columns if c not in PLACE]
    # Missing values leave a hash as it was, so it is told which are missing.
    missing = sum((F.col(c).isNull().cast("decimal(38,0)") * (1 << k % 100) for k, c in enumerate(names)), F.lit(0))
    brief = reduce(DataFrame.unionByName, (
        rows.select(key, F.xxhash64(missing, *names).alias("_digest"), *PLACE, F.lit(number).alias("_side"))
        for number, rows in zip((-1, 1), sides)))
    equal = Window.partitionBy(key, "_digest")

    def surplus(rows: DataFrame) -> DataFrame:
        net = rows.withColumn("_net", F.sum("_side").over(equal)).filter("_net * _side > 0")
        one = net.withColumn("_rank", F.row_number().over(equal.orderBy(*PLACE))).filter("_rank = 1")
        return one.select(key, *PLACE, (F.col("_net") > 0).alias("_new"), F.abs("_net").alias("copies"))

    # A key has a row or two here, as tables are unique on it; rows without one do not meet.
    of_key = Window.partitionBy(key)
    keyed = surplus(brief.filter(F.col(key).isNotNull()).repartition(key)).withColumns(
        {"_gone": F.max(~F.col("_new")).over(of_key), "_came": F.max("_new").over(of_key)})
    keyed = keyed.filter(F.col("_new") | ~F.col("_came"))
    rest = surplus(brief.filter(F.col(key).isNull())).withColumns({"_gone": ~F.col("_new"), "_came": F.col("_new")})
    change = F.when(F.col("_gone") & F.col("_came"), UPDATED).when(F.col("_came"), ADDED).otherwise(DELETED)
    return keyed.unionByName(rest).select(change.alias("change"), "copies", *PLACE)


def _counts(changes: DataFrame) -> DataFrame:
    def number(kind: str):
        return F.coalesce(F.sum(F.when(F.col("change") == kind, F.col("copies"))), F.lit(0)).cast("bigint")

    return changes.agg(number(ADDED).alias("added"), number(DELETED).alias("removed"), number(UPDATED).alias("changed"))


def version_diff(store: Store, table: str, before: int, after: int,
                 key: str = TRADE_KEY) -> DataFrame:
    """How many rows were added, removed and changed between two versions, by key."""
    return _counts(_changed_places(_rewritten(store, table, before, after), key))


def version_history(store: Store, table: str, key: str = TRADE_KEY) -> DataFrame:
    """``version, parent, operation, added, removed, changed`` of every version kept, against its parent.

    A first version adds all its rows. One plan for each version, each reading only the parts it does not share.
    """
    rows = []
    for version in store.versions(table):
        manifest = store.manifest(table, version)
        if manifest["parent"]:
            counts = version_diff(store, table, manifest["parent"], version, key)
        else:
            none = F.lit(0).cast("bigint")
            counts = store.read(table, version=version).agg(F.count(F.lit(1)).alias("added")).select(
                "added", none.alias("removed"), none.alias("changed"))
        rows.append(counts.select(
            F.lit(version).alias("version"), F.lit(manifest["parent"]).cast("int").alias("parent"),
            F.lit(manifest["operation"]).alias("operation"), "added", "removed", "changed"))
    return reduce(DataFrame.unionByName, rows)
