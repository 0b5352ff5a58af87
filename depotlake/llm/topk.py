"""Exact top-k inner products by norm-bucketed retrieval.

Vectors become integers and are grouped by length (geometric buckets of the norm), and a bucket into blocks of at
most about ``BLOCK`` vectors by a hash of the id. A first pass scores each query against one block of long vectors;
its k-th best product bounds the result from below. A block that cannot reach the bound with its longest vector
never meets the query. For the blocks left, the bound divided by both lengths is a local cosine threshold: where
it is high, vectors outside the range that their largest query coordinates allow are dropped (coordinate
pruning), else those too short (length pruning). What is left is verified with whole products.

Queries meet blocks in chunks of ``CHUNK``, so a task holds one block and one chunk at a time, whatever the
lengths are: even if all vectors have one norm, their blocks are spread by hash.

Defined results: ids or vectors that are NULL, vectors that are empty or hold a NULL or non-finite component, take
no part; a query meets only vectors of its own dimension; rows that repeat the query's id are the query itself, of
which the smallest vector asks; other repeated rows are candidates of their own. Ties go to the smaller id. Components beyond 2^24 times 1/64 are
multiplied as 64-bit integers, smaller ones as doubles, which are exact there.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from depotlake.llm.common import settled

SCALE = 64
RATIO = 1.1
BLOCK = 4_096
CHUNK = 2_048
HIGH_COSINE = 0.6
FOCUS = 4


def _usable(vector: Column) -> Column:
    return (F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (
        F.abs(x) < F.lit(float("inf"))))


def integers(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, v, dim, norm, bucket`` of the rows that take part."""
    doubles = F.transform(F.col(vector), lambda x: x.cast("double"))
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), doubles.alias("d")).where(
        F.col("vec_id").isNotNull() & F.col("d").isNotNull() & _usable(F.col("d")))
    whole = rows.select("vec_id", F.transform("d", lambda x: F.floor(x * SCALE).cast("long")).alias("v"))
    squares = F.aggregate("v", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    return whole.select("vec_id", "v", F.size("v").alias("dim"), F.sqrt(squares).alias("norm")).withColumn(
        "bucket", F.when(F.col("norm") < 1, -1).otherwise(F.floor(F.log("norm") / math.log(RATIO))).cast("int"))


def _products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    largest = float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0))
    if largest * max(1, queries.shape[-1]) < 2 ** 53:
        return queries.astype(float) @ vectors.astype(float).T
    return queries @ vectors.T


def _best(scores: np.ndarray, ids: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    allowed = ids != own
    scores, ids = scores[allowed], ids[allowed]
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = scores >= least
        scores, ids = scores[near], ids[near]
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def _search(block: pd.DataFrame, chunk: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best of one block for each query of one chunk."""
    out: list[tuple] = []
    if len(block) and len(chunk):
        vectors, ids, norms = np.array(block["w"].tolist(), np.int64), block["candidate"].to_numpy(), block["length"].to_numpy()
        queries = np.array(chunk["v"].tolist(), np.int64)
        lengths, bounds = chunk["norm"].to_numpy(), chunk["bound"].to_numpy(float)
        longest = norms.max()
        with np.errstate(divide="ignore", invalid="ignore"):
            cosines = bounds / (lengths * longest)
            unit = vectors / np.maximum(norms, 1e-300)[:, None]
        pruned = np.isfinite(cosines) & (cosines > 0)
        by_coordinate = pruned & (cosines >= HIGH_COSINE)
        dense = ~by_coordinate
        scores = _products(queries[dense], vectors) if dense.any() else None
        for place, at in enumerate(np.flatnonzero(dense)):
            row = scores[place]
            if pruned[at]:
                near = norms * lengths[at] * (1 + 1e-9) >= bounds[at]
                best = _best(row[near], ids[near], chunk["vec_id"].iat[at], k)
            else:
                best = _best(row, ids, chunk["vec_id"].iat[at], k)
            out.extend((chunk["vec_id"].iat[at], int(i), int(s)) for s, i in zip(*best))
        for at in np.flatnonzero(by_coordinate):
            direction, cosine = queries[at] / lengths[at], min(1.0, cosines[at] * (1 - 1e-9))
            near = np.ones(len(ids), bool)
            for focus in np.argsort(-np.abs(direction))[:FOCUS]:
                middle = direction[focus] * cosine
                reach = math.sqrt(max(0.0, (1 - cosine ** 2) * (1 - direction[focus] ** 2))) + 1e-9
                upper = 1.0 if direction[focus] >= cosine else middle + reach
                lower = -1.0 if direction[focus] <= -cosine else middle - reach
                near &= (unit[:, focus] <= upper) & (unit[:, focus] >= lower)
            near &= norms * lengths[at] * (1 + 1e-9) >= bounds[at]
            best = _best(_products(queries[at:at + 1], vectors[near])[0], ids[near], chunk["vec_id"].iat[at], k)
            out.extend((chunk["vec_id"].iat[at], int(i), int(s)) for s, i in zip(*best))
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")


def _met(blocks: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    """Each block with the chunks of queries that it meets; ``pairs`` has one row for each query and block."""
    keys = ["dim", "bucket", "part", "chunk"]
    chunks = pairs.select(*[F.col(key).alias(f"{key}_met") for key in keys]).distinct()
    same = [F.col(key) == F.col(f"{key}_met") for key in keys[:3]]
    left = blocks.join(chunks, same).select(
        F.col("vec_id").alias("candidate"), F.col("v").alias("w"), F.col("norm").alias("length"),
        *[f"{key}_met" for key in keys])
    return left.groupBy(*[f"{key}_met" for key in keys]).cogroup(pairs.groupBy(*keys)).applyInPandas(
        lambda block, chunk: _search(block, chunk, k), "query_id long, vec_id long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_products(vectors: DataFrame, is_query: Column, k: int, vec_id: str = "vec_id",
                 vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k best vectors for every row that ``is_query`` (over vec_id) names."""
    rows = settled(integers(vectors, vec_id, vector), "vectors")
    sizes = rows.groupBy("dim", "bucket").agg(F.count("*").alias("n"))
    parts = F.greatest(F.lit(1), F.ceil(F.col("n") / BLOCK)).cast("int")
    spread = sizes.select("dim", "bucket", parts.alias("parts"))
    blocks = rows.join(F.broadcast(spread), ["dim", "bucket"]).withColumn(
        "part", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int")).drop("parts")
    listed = blocks.groupBy("dim", "bucket", "part").agg(F.max("norm").alias("longest"), F.count("*").alias("n"))
    listed = settled(listed, "blocks")
    asked = rows.where(is_query).groupBy("vec_id").agg(F.min(F.struct("v", "dim", "norm")).alias("own")).select(
        "vec_id", "own.*")
    chunks = max(1, math.ceil(asked.count() / CHUNK))
    queries = asked.select(F.col("vec_id"), "v", "dim", "norm",
                           F.pmod(F.xxhash64("vec_id"), F.lit(chunks)).cast("int").alias("chunk"))

    first = listed.where(F.col("n") > k).groupBy("dim").agg(F.max(F.struct("bucket", "part")).alias("at"))
    seeds = queries.join(F.broadcast(first), "dim").select(
        "vec_id", "v", "dim", "norm", "chunk", F.col("at")["bucket"].alias("bucket"), F.col("at")["part"].alias("part"),
        F.lit(None).cast("double").alias("bound"))
    bounds = _met(blocks, seeds, k).groupBy("query_id").agg(
        F.when(F.count("*") >= k, F.min("score")).cast("double").alias("bound"))
    known = settled(queries.join(bounds, F.col("vec_id") == F.col("query_id"), "left").drop("query_id"), "bounds")
    # Blocks are few (their number is that of the vectors over BLOCK); queries meet those that they cannot rule out.
    pairs = known.join(listed.drop("n"), "dim").where(
        F.col("bound").isNull() | (F.col("norm") * F.col("longest") * (1 + 1e-9) >= F.col("bound"))).drop("longest")
    return _ranked(_met(blocks, pairs, k), k).select("query_id", "rank", "vec_id", "score")
