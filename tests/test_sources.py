from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from depotlake.functions import expressions as ex
from depotlake.model import TRADE
from depotlake.operators import marts, reports
from depotlake.sources import ingest, writers
from depotlake.session import build_session, shared_root, workspace
from depotlake.sources.shared_files import AlreadyThereError, SharedFiles
from pyspark.sql import functions as F


def test_jdbc_ranges_are_options_of_the_reader():
    options = ingest.jdbc_scan_options("jdbc:x", "trade", "trade_id", 10, 50, 4)
    assert options == {"url": "jdbc:x", "dbtable": "trade", "partitionColumn": "trade_id",
                       "lowerBound": "10", "upperBound": "50", "numPartitions": "4",
                       "fetchsize": "10000"}
    # One id only: the upper bound must stay above the lower one.
    assert ingest.jdbc_scan_options("u", "t", "k", 7, 7)["upperBound"] == "8"


def test_typed_casts_by_name(spark):
    text = spark.createDataFrame([("7", "2.5", "junk")], "trade_id string, qty string, other string")
    wanted = TRADE.__class__([TRADE["trade_id"], TRADE["qty"]])
    row = ingest.typed(text, wanted).first()
    assert tuple(row) == (7, Decimal("2.5000"))


def test_bounds_and_increment(trade_rows):
    rows = trade_rows({}, {"trade_id": 9, "updated_ts": datetime(2021, 1, 1)})
    row = ingest.key_bounds(rows, "trade_id", "trade_date").first()
    assert (row.lo, row.hi, row.n) == (1, 9, 2)
    assert ingest.changed_since(rows, datetime(2021, 1, 1)).count() == 1
    assert ingest.high_water_mark(rows) == datetime(2021, 1, 1)
    assert ingest.high_water_mark(rows.filter("false")) is None


def test_files_are_created_once(spark):
    files, path = SharedFiles(spark), workspace(spark, "files") + "/a.json"
    files.create(path, {"n": 1, "text": "ü"})
    with pytest.raises(AlreadyThereError):
        files.create(path, {"n": 2})
    assert files.read(path) == {"n": 1, "text": "ü"}
    assert files.names("/nonexistent/folder") == []


def test_shared_folder_comes_from_the_session(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert workspace(spark, "x") != workspace(spark, "x")
    assert build_session("tests", input_bytes=1 << 30) is spark
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_dynamic_and_static_overwrite_on_a_shrunk_source(spark, trade_rows):
    rows = trade_rows({}, {"trade_id": 2, "trade_ts": datetime(2020, 2, 1)}).withColumn(
        "trade_month", ex.month_of("trade_ts"))
    shrunk = rows.filter("trade_month = '2020-02'")
    path = workspace(spark, "shrunk")
    writers.full_refresh(rows, path, ["trade_month"])
    writers.overwrite_partitions(shrunk, path, ["trade_month"])
    assert spark.read.parquet(path).count() == 2
    writers.full_refresh(shrunk, path, ["trade_month"])
    assert spark.read.parquet(path).count() == 1


def test_a_hot_partition_is_written_by_several_tasks(spark):
    """A month with most rows does not become one task's file."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200000")
    try:
        rows = spark.range(0, 200_000, 1, 8).select(
            F.when(F.col("id") % 10 == 0, "cold").otherwise("hot").alias("trade_month"),
            F.sha2(F.col("id").cast("string"), 256).alias("text"))
        path = workspace(spark, "hot")
        writers.write_clustered(rows, path, ["trade_month"])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(128 << 20))
    files = SharedFiles(spark).names(f"{path}/trade_month=hot")
    assert sum(f.endswith(".parquet") for f in files) > 3
    assert spark.read.parquet(path).count() == 200_000


def test_bloom_filters_are_written(spark, trade_rows):
    import pyarrow.parquet as pq
    path = workspace(spark, "bloom")
    rows = trade_rows(*({"trade_id": i, "investor_id": i * 7919 % 1000} for i in range(500)))
    writers.write_clustered(rows, path, (), ("trade_date",), ("investor_id",))
    plain = workspace(spark, "plain")
    writers.write_clustered(rows, plain, (), ("trade_date",))

    def size(folder):
        names = [n for n in SharedFiles(spark).names(folder) if n.endswith(".parquet")]
        return sum(pq.ParquetFile(f"{folder}/{n}").metadata.serialized_size for n in names), sum(
            __import__("os").path.getsize(f"{folder}/{n}") for n in names)

    assert size(path)[1] > size(plain)[1]


def test_zero_quantity_has_no_average_price(silver_rows):
    rows = silver_rows({"qty": Decimal(1)}, {"trade_id": 2, "qty": Decimal(-1)})
    assert marts.daily_security(rows).first().vwap is None


def test_marts_by_hand(silver_rows):
    rows = silver_rows(
        {}, {"trade_id": 2, "investor_id": 11, "side": "SELL", "signed_qty": Decimal(-2)},
        {"trade_id": 3, "price": Decimal(8), "qty": Decimal(1), "amount": Decimal(8),
         "signed_qty": Decimal(1), "net_amount": Decimal("7.9")})
    day = marts.daily_security(rows).first()
    assert (day.trade_count, day.volume, day.buy_volume, day.sell_volume) == (3, 28, 18, 10)
    assert (day.unique_investors, day.vwap, day.min_price, day.max_price) == (2, Decimal("5.6"), 5, 8)
    held = {r.investor_id: (r.net_qty, r.net_cash) for r in marts.positions(rows).collect()}
    assert held == {10: (3, Decimal("-17.8")), 11: (-2, Decimal("9.9"))}
    broker = marts.broker_daily(rows).first()
    assert (broker.trade_count, broker.unique_investors, broker.unique_securities) == (3, 2, 1)


def test_partition_transforms(spark):
    row = spark.sql("select timestamp_ntz '2020-03-04 05:06:07' as t, 42L as k").select(
        ex.month_of("t").alias("m"), F.expr(ex.by_day("t")).alias("d"), F.expr(ex.by_year("t")).alias("y"),
        ex.month_start("t").alias("s"), F.expr(ex.by_bucket("k", 16)).alias("b")).first()
    assert (row.m, str(row.d), row.y, str(row.s)) == ("2020-03", "2020-03-04", 2020, "2020-03-01")
    assert 0 <= row.b < 16


@pytest.mark.parametrize("n, size, count", [
    (12, "12.00 B", "12.00"), (1536, "1.50 KiB", "1.54 thousand"),
    (3 << 20, "3.00 MiB", "3.15 million"), (5 << 40, "5.00 TiB", "5,497.56 billion")])
def test_readable_numbers(spark, n, size, count):
    row = spark.range(1).select(ex.human_size(F.lit(n)).alias("s"), ex.human_count(F.lit(n)).alias("c")).first()
    assert (row.s, row.c) == (size, count)


def test_speedup_of_a_free_layer(spark):
    costs = spark.createDataFrame([("a", 100), ("b", 4), ("c", 0)], "layer string, ms bigint")
    found = {r.layer: r.factor for r in reports.speedup(costs, "layer", "ms").collect()}
    assert found == {"a": 1, "b": 25, "c": 100}


def test_a_hot_group_is_counted_by_many_tasks(silver_rows):
    """Distinct counts shuffle by group and counted value before the last merge."""
    from conftest import plan_of
    for mart in (marts.daily_security, marts.broker_daily):
        first_shuffle = plan_of(mart(silver_rows({}))).split("Exchange hashpartitioning(")[-1]
        assert "investor_id" in first_shuffle.split(")")[0]


def test_files_written_by_range_do_not_overlap(spark):
    """Also when one investor owns a third of the rows: further sort columns split it."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(0, 9000, 1, 4).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") * 37 % 1000).alias("investor_id"),
            F.col("id").alias("security_id"))
        path = workspace(spark, "ranges")
        writers.write_clustered(rows, path, (), ("investor_id", "security_id"), by_range=True)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    key = F.struct("investor_id", "security_id")
    files = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("f")).agg(
        F.min(key).alias("lo"), F.max(key).alias("hi"), F.count(F.lit(1)).alias("n"))
    found = sorted((tuple(r.lo), tuple(r.hi), r.n) for r in files.collect())
    assert len(found) == 4 and sum(n for _, _, n in found) == 9000
    assert all(a[1] < b[0] for a, b in zip(found, found[1:]))
    assert max(n for _, _, n in found) < 4500
