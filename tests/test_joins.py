from __future__ import annotations

import pytest
from conftest import plan_of
from depotlake.operators.joins import broadcast_if_small, join_dimension, measured_bytes
from depotlake.session import shuffle_partitions_for
from pyspark.sql import functions as F


def test_size_covers_rows_and_text(spark):
    few = spark.range(100).select("id", F.lit("x" * 1000).alias("text"))
    assert 100_000 < measured_bytes(few) < 120_000
    assert measured_bytes(few.filter("id < 0")) == 0


def test_a_small_dimension_is_broadcast(trade_rows, investors):
    plan = plan_of(join_dimension(trade_rows({}), investors, "investor_id"))
    assert "BroadcastHashJoin" in plan


@pytest.fixture
def no_auto_broadcast(spark):
    saved = {}
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for key, value in settings.items():
        saved[key] = spark.conf.get(key)
        spark.conf.set(key, value)
    yield
    for key, value in saved.items():
        spark.conf.set(key, value)


def test_a_large_dimension_is_shuffled_and_a_hot_key_split(spark, no_auto_broadcast):
    """A key with a third of all rows is read by several tasks, nothing is lost."""
    facts = spark.range(0, 30_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 500).alias("investor_id"), "id")
    dimension = spark.range(500).select(F.col("id").alias("investor_id"),
                                        F.concat(F.lit("t"), "id").alias("type"))
    joined = join_dimension(facts, dimension, "investor_id", limit=10)
    assert broadcast_if_small(dimension, 10) is dimension
    assert joined.count() == 30_000
    rows = joined.groupBy("type").count().filter("type = 't1'").first()["count"]
    assert rows == 10_040
    out = joined.select("id", "type")
    out.write.format("noop").mode("overwrite").save()
    out.collect()
    assert "skew=true" in plan_of(out)


def test_reducers_follow_the_data():
    assert shuffle_partitions_for(0, 8) == 8
    assert shuffle_partitions_for(10 << 30, 8) == 80
    assert shuffle_partitions_for(100 << 40, 8) == 819_200
