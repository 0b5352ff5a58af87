"""Row-level changes: upsert by key, update, update where."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from depotlake.functions.expressions import holds
from depotlake.model import LATEST_FIRST, TRADE_KEY
from depotlake.operators.dedup import latest_per_key
from depotlake.operators.joins import BROADCAST_LIMIT_BYTES, broadcast_if_small
from depotlake.session import shuffles_removed, workspace
from depotlake.sources.store import FILE, FILE_BYTES, FILE_ROW, PART, ConflictError, Store

NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
# Columns of a row's place, and the rows that a bitmap of places covers.
PLACE = ("_in", "_row")
MARK_BITS = 15
MARK_ROWS = 1 << MARK_BITS


def matches(target: DataFrame, changes: DataFrame, key: str, stamp: str,
            limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Target rows some change refers to, and whether the change is strictly newer.
    Only keys and stamps are read; the target is not shuffled for a small batch."""
    places = [F.col(c).alias(f"_change{c}") for c in PLACE if c in changes.columns]
    batch = broadcast_if_small(changes.select(key, F.col(stamp).alias("_change"), *places), limit)
    own = [c for c in (PART, *PLACE) if c in target.columns]
    newer = holds(F.col("_change") > F.col(stamp)).alias("newer")
    sent = [c for c in batch.columns if c not in (key, "_change")]
    return target.select(key, stamp, *own).join(batch, key).select(key, *own, *sent, newer)


def placed(rows: DataFrame) -> DataFrame:
    """Rows of ``Store.read`` with their files, with their place instead: a hash of the file, and the row in it. Two
    files of one hash, which is improbable, would be taken for one."""
    own = [c for c in rows.columns if c not in (FILE, FILE_BYTES, FILE_ROW)]
    return rows.select(*own, F.xxhash64(FILE).alias(PLACE[0]), F.col(FILE_ROW).alias(PLACE[1]))


def marks(places: DataFrame) -> DataFrame:
    """Places as bitmaps, one for every ``MARK_ROWS`` rows of a file that hold any."""
    file, row = places.columns
    blocks = places.select(F.col(file).alias("_marked"), F.shiftright(row, MARK_BITS).alias("_block"),
                           F.col(row).bitwiseAND(MARK_ROWS - 1).alias("_at"))
    # Dealt as places, which are smaller than the bitmaps that every task would have of its own.
    return blocks.repartition("_marked", "_block").groupBy("_marked", "_block").agg(
        F.bitmap_construct_agg("_at").alias("_bits"))


def _met(rows: DataFrame, marked: DataFrame, how: str) -> tuple[DataFrame, Column]:
    """``rows`` with the bitmap of their block, and their bit of it."""
    file, row = (F.col(c) for c in PLACE)
    at = row.bitwiseAND(MARK_ROWS - 1)
    byte = F.conv(F.hex(F.substring("_bits", F.shiftright(at, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.call_function("shiftright", byte, at.bitwiseAND(7).cast("int")).bitwiseAND(1)
    return rows.join(marked, (file == F.col("_marked")) & (F.shiftright(row, MARK_BITS) == F.col("_block")), how), bit


def unmarked(rows: DataFrame, marked: DataFrame) -> DataFrame:
    """The rows whose places are not in the bitmaps ``marked``. Bitmaps take an eighth of a byte a row, so that rows
    stay where they are up to half a billion of them; beyond it they meet by file and block."""
    met, bit = _met(rows, broadcast_if_small(marked, BROADCAST_LIMIT_BYTES), "left")
    return met.filter(F.col("_bits").isNull() | (bit == 0)).select(*rows.columns)


def at_marks(rows: DataFrame, marked: DataFrame) -> DataFrame:
    """The rows whose places are in the bitmaps ``marked``."""
    met, bit = _met(rows, marked, "inner")
    return met.filter(bit == 1).select(*rows.columns)


def without(rows: DataFrame, keys: DataFrame, key: str,
            limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """``rows`` whose key is not among ``keys``. Rows without a key match nothing and stay out of the join, whose
    shuffle would bring all of them to one task."""
    keyed = rows.filter(F.col(key).isNotNull()).join(broadcast_if_small(keys.select(key), limit), key, "left_anti")
    return keyed.select(*rows.columns).unionByName(rows.filter(F.col(key).isNull()))


def merge(target: DataFrame, source: DataFrame, key: str = TRADE_KEY,
          newest_first: Sequence[str] = LATEST_FIRST) -> DataFrame:
    """The target after an upsert: newer changes replace, unknown keys come in,
    older or equally old changes are ignored. ``target`` is unique on ``key``.

    Both sides are read once and ranked together, so there is one shuffle, and
    each map task sends one row per key. A target row without a stamp stays:
    nothing is known to be newer. Rows without a key match nothing and are kept.
    """
    stamp, *ties = newest_first
    rows = target.withColumn("_new", F.lit(False)).unionByName(
        source.select(*target.columns).withColumn("_new", F.lit(True)))
    rest = [c for c in target.columns if c != key and c not in newest_first]
    settled = ~F.col("_new") & F.col(stamp).isNull()
    order = [settled.desc(), F.col(stamp).desc_nulls_last(), F.col("_new").asc(),
             *(F.col(c).desc_nulls_last() for c in (*ties, *rest))]
    keyed = rows.filter(F.col(key).isNotNull())
    ranked = keyed.withColumn("_rank", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    first = ranked.filter("_rank = 1").select(*target.columns)
    return first.unionByName(rows.filter(F.col(key).isNull()).select(*target.columns))


def retried(attempt: Callable[[], int], tries: int = 5) -> int:
    """The result of ``attempt``, which starts again from its read when another writer came first."""
    for left in reversed(range(tries)):
        try:
            return attempt()
        except ConflictError:
            if not left:
                raise
    raise AssertionError("unreachable")


def latest_of_batch(source: DataFrame, key: str, newest_first: Sequence[str]) -> DataFrame:
    """One row for each key; rows without a key match nothing and are all kept, as in ``merge``."""
    keyed = latest_per_key(source.filter(F.col(key).isNotNull()), (key,), newest_first)
    return keyed.unionByName(source.filter(F.col(key).isNull()))


def upsert_into(store: Store, table: str, source: DataFrame, ref: str, key: str = TRADE_KEY,
                newest_first: Sequence[str] = LATEST_FIRST, sort_by: Sequence[str] = (),
                layout: Mapping[str, str] | None = None,
                batch: tuple[str, int] | None = None, immutable: Sequence[str] = ()) -> int:
    """Upsert into a stored table, rewriting only parts that hold a replaced row.

    Where the layout has a bucket of the key, only folders of the batch's buckets are read, and a part is one bucket
    of one month. ``immutable`` names columns that no change of a row alters; folders follow them too.
    A row whose change moves it to another partition leaves its old part that
    way. ``batch`` names a feed and a batch of it: one already contained is skipped.
    Rows without a key are all added. When another writer changes the table
    meanwhile, the upsert starts again from what the table shows then.
    """
    current = store.state(ref).get(table)
    if current and batch and store.applied(table, ref, batch[0]) >= batch[1]:
        return current
    scratch = workspace(store.spark, "upsert")
    # The batch is written once: a live source may answer differently the next time.
    with shuffles_removed(store.spark):
        latest_of_batch(source, key, newest_first).write.parquet(f"{scratch}/changes")
    changes = store.spark.read.parquet(f"{scratch}/changes")
    version = retried(lambda: _upsert(store, table, changes, ref, key, newest_first, sort_by, layout, batch, immutable))
    store.files.remove(scratch)
    return version


def fixed_layout(changes: DataFrame, layout: Sequence[Mapping[str, str]], fixed: Sequence[str]) -> list[str]:
    """The layout columns that the columns ``fixed`` alone determine, such as a bucket of the key."""
    alone = changes.select(*fixed)
    found = []
    for column in layout:
        try:
            alone.select(F.expr(column["expr"]))
        except AnalysisException:  # it needs a column that a change may give another value
            continue
        found.append(column["name"])
    return found


def reachable_parts(store: Store, table: str, version: int, changes: DataFrame, key: str,
                    immutable: Sequence[str] = ()) -> list[str] | None:
    """The parts of a version that can hold a row some change refers to; None for all of them.

    A layout column made of the key (and of columns declared immutable) has one value for all rows of a key, so
    the values of the batch tell the folders to look in. Those values are at most as many as there are folders;
    when a batch reaches most of them anyway, all parts are read. Parts written with another layout are always read.
    """
    manifest = store.manifest(table, version)
    names = fixed_layout(changes, manifest["layout"], (key, *immutable))
    if not names:
        return None
    exprs = [F.expr(c["expr"]).cast("string").alias(c["name"]) for c in manifest["layout"] if c["name"] in names]
    keyed = changes.filter(F.col(key).isNotNull())
    places = {tuple(row) for row in keyed.select(*exprs).distinct().limit(len(manifest["parts"]) + 1).collect()}
    if len(places) > len(manifest["parts"]):
        return None

    def holds_place(folder: str) -> bool:
        values = part_values(folder)
        return any(name not in values for name in names) or tuple(values[name] for name in names) in places

    return [p["dir"] for p in manifest["parts"] if holds_place(p["dir"])]


def part_values(folder: str) -> dict[str, str | None]:
    """The layout values that the path of a part tells."""
    pairs = (step.split("=", 1) for step in folder.split("/") if "=" in step)
    return {name: None if value == NULL_FOLDER else unquote(value) for name, value in pairs}


def kept(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to ``path`` and read again, as more than one job asks for it."""
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _upsert(store: Store, table: str, changes: DataFrame, ref: str, key: str,
            newest_first: Sequence[str], sort_by: Sequence[str], layout: Mapping[str, str] | None,
            batch: tuple[str, int] | None, immutable: Sequence[str] = ()) -> int:
    """One attempt, from the version the ref shows now to the next one.

    Keys meet once, with the places of their rows. What is left out of the table and of the batch is then told by
    bitmaps of places, so neither is shuffled for it.
    """
    current = store.state(ref).get(table)
    if current and batch and store.applied_in(table, current, batch[0]) >= batch[1]:
        return current
    if not current:
        return store.write(table, changes, ref, "upsert", layout, sort_by, batch=batch, expected=None)
    spark = store.spark
    scratch = workspace(spark, "upsert")
    names = [c["name"] for c in store.manifest(table, current)["columns"]]
    within = reachable_parts(store, table, current, changes, key, immutable)
    target = placed(store.read(table, version=current, parts=within, with_part=True, with_file=True))
    changes = changes.select("*", F.xxhash64("_metadata.file_path").alias(PLACE[0]),
                             F.col("_metadata.row_index").alias(PLACE[1]))
    # A replaced key takes all its rows along, should the table hold it more than once.
    replaced = F.max("newer").over(Window.partitionBy(key))
    with shuffles_removed(spark):
        matches(target, changes, key, newest_first[0]).withColumn("replaced", replaced).drop(key).write.parquet(
            f"{scratch}/matches")
    hit = spark.read.parquet(f"{scratch}/matches")
    # As many values as the table has parts with a replaced row.
    dropped = [r[PART] for r in hit.filter("newer").select(PART).distinct().collect()]
    known = hit.filter("not newer").select(*(f"_change{c}" for c in PLACE))
    fresh = unmarked(changes, kept(marks(known), f"{scratch}/known")).select(*names)
    # A row without a key is fresh, which a scan tells; only else the join is asked.
    if not dropped and changes.filter(F.col(key).isNull()).isEmpty() and fresh.isEmpty():
        store.files.remove(scratch)
        return current
    rows = fresh
    if dropped:
        affected = placed(store.read(table, version=current, parts=dropped, with_file=True))
        gone = kept(marks(hit.filter("replaced").select(*PLACE)), f"{scratch}/gone")
        rows = unmarked(affected, gone).select(*names).unionByName(fresh)
    version = store.write(table, rows, ref, "upsert", layout, sort_by, dropped=dropped,
                          batch=batch, expected=current)
    store.files.remove(scratch)
    return version


def update_all(df: DataFrame, changes: Mapping[str, Column]) -> DataFrame:
    """New values for every row, in the type the column had."""
    return df.withColumns({name: value.cast(df.schema[name].dataType)
                           for name, value in changes.items()})


def update_where(df: DataFrame, condition: Column, changes: Mapping[str, Column]) -> DataFrame:
    """New values where the condition is true; other rows stay, also for NULL."""
    return update_all(df, {name: F.when(holds(condition), value).otherwise(F.col(name))
                           for name, value in changes.items()})


def resent_batch(trades: DataFrame, key_shift: int, channel: str) -> DataFrame:
    """A faulty delivery: trades sent again under new keys, with amounts in hundredths."""
    return update_all(trades, {
        "trade_id": F.col("trade_id") + key_shift,
        "amount": F.col("amount") * 100,
        "channel": F.lit(channel),
    })


def sample_batch(trades: DataFrame, order_by: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows in a stated order."""
    return trades.orderBy(*order_by).limit(n)
