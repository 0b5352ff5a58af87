"""The given Parquet tables seen as trades, investors and securities."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depotlake.model import BUY, SELL


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _priced_lines(spark: SparkSession, folder: str) -> DataFrame:
    line = table(spark, folder, "lineitem")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    # Two casts: a double quotient first rounds to 8 digits, then to 6, which
    # makes ties come out the same in every engine.
    price = (F.try_divide("l_extendedprice", "l_quantity")
             .cast("decimal(18,8)").cast("decimal(18,6)"))
    return line.join(orders, line.l_orderkey == orders.o_orderkey).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("trade_id"),
        F.col("o_custkey").alias("investor_id"),
        F.col("l_partkey").alias("security_id"),
        F.col("l_suppkey").alias("broker_id"),
        F.col("l_shipdate").alias("trade_ts"),
        F.to_date("l_shipdate").alias("trade_date"),
        F.when(F.col("l_linestatus") == "O", BUY).otherwise(SELL).alias("side"),
        F.col("l_quantity").cast("decimal(18,4)").alias("qty"),
        price.alias("price"),
        F.col("l_extendedprice").cast("decimal(20,4)").alias("amount"),
        (F.col("l_extendedprice") * F.col("l_discount")).cast("decimal(12,4)").alias("commission"),
        F.col("o_orderpriority").alias("channel"),
        F.col("l_shipdate").alias("updated_ts"),
        F.col("l_tax").cast("decimal(4,2)").alias("tax"),
        F.col("l_discount").cast("decimal(4,2)").alias("discount"),
    )


#: Trades that one task may take where a query fixes the number of its tasks: some 80 MB shuffled.
ROWS_PER_TASK = 1_000_000


def tasks_for_trades(spark: SparkSession, folder: str, least: int) -> int:
    """``least`` tasks, or as many times that as the trades need; counted from file footers."""
    rows = table(spark, folder, "lineitem").count()
    return least * max(1, -(-rows // (least * ROWS_PER_TASK)))


def trades(spark: SparkSession, folder: str) -> DataFrame:
    """Every trade message, repeated keys included."""
    return _priced_lines(spark, folder).drop("tax", "discount")


def faulty_trades(spark: SparkSession, folder: str) -> DataFrame:
    """The same messages as a careless feed would send them.

    Lines at the top discount carry a fault that their tax rate selects: no
    amount, negative quantity, no side, or a side that does not exist.
    """
    fault = F.when(F.col("discount") == 0.10, F.col("tax"))
    return _priced_lines(spark, folder).withColumns({
        "amount": F.when(fault == 0.08, None).otherwise(F.col("amount")).cast("decimal(20,4)"),
        "qty": F.when(fault == 0.07, -F.col("qty")).otherwise(F.col("qty")).cast("decimal(18,4)"),
        "side": F.when(fault == 0.06, None).when(fault == 0.05, F.lit("X"))
                 .otherwise(F.col("side")),
    }).drop("tax", "discount")


def investors(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer")
    nation = table(spark, folder, "nation")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.col("c_custkey").alias("investor_id"),
        F.col("c_mktsegment").alias("investor_type"),
        F.col("n_name").alias("country"),
        (F.col("c_acctbal") >= 0).alias("active"),
    )


def securities(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("security_id"),
        F.col("p_name").alias("short_code"),
        F.col("p_type").alias("security_type"),
        F.col("p_brand").alias("market"),
    )


def listed_securities(spark: SparkSession, folder: str) -> DataFrame:
    """Securities with a listing (small sizes only); trades in others do not match."""
    part = table(spark, folder, "part")
    return part.filter(F.col("p_size") <= 45).select(
        F.col("p_partkey").alias("security_id"),
        F.col("p_name").alias("short_code"),
        F.col("p_type").alias("security_type"),
        F.col("p_brand").alias("market"),
    )
