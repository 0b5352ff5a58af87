"""Connected components of a graph given as links, by joins and aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotlake.llm.common import removed, settled

MAX_ROUNDS = 100
SALTS = 64


def _with_least(links: DataFrame) -> DataFrame:
    """``(a, b, least)``: each link with the least b of its a.

    The links of one node are dealt over ``SALTS`` tasks by their other end; only one row for each of these shares meets
    at the node.
    """
    salted = links.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)))
    shares = salted.groupBy("a", "salt").agg(F.min("b").alias("least"))
    least = shares.groupBy("a").agg(F.min("least").alias("least"))
    return salted.join(shares.select("a", "salt").join(least, "a"), ["a", "salt"]).select("a", "b", "least")


def _toward_least(links: DataFrame) -> DataFrame:
    """Every node's larger neighbours are handed to the least node it knows."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return _with_least(both).where("b > a").select(F.col("b").alias("a"), F.least("a", "least").alias("b"))


def _hang_on_least(links: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours hang on the least of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b")
    ends = F.explode(F.array("a", "b")).alias("a")
    return _with_least(down).select(ends, F.col("least").alias("b")).where("a > b").distinct()


def _are_stars(links: DataFrame) -> bool:
    """Whether every node but the centres has one link ``a > b`` only, and that to a centre."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("up")).union(
        links.select(F.col("b").alias("node"), F.lit(0).alias("up")))
    places = ends.groupBy("node").agg(F.sum("up").alias("ups"), F.min("up").alias("least"))
    return places.where("ups > 1 or (ups = 1 and least = 0)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links (a, b)``; the component is its least node.

    Links are turned into stars in alternating rounds, each written to the shared folder: their number does not
    grow, and the number of rounds follows the logarithm of the longest path. After each one query asks whether all
    links are stars, which no round would change. More than ``MAX_ROUNDS`` rounds, which no path of this world needs,
    raise RuntimeError.
    """
    stars = settled(_hang_on_least(links), "links")
    for _ in range(MAX_ROUNDS):
        if _are_stars(stars):
            break
        last, stars = stars, settled(_hang_on_least(_toward_least(stars)), "links")
        removed(last)
    else:
        raise RuntimeError("components did not settle")
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
