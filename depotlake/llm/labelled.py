"""A bounded sample of labelled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotlake.llm.common import bounded_sample


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, rows: int,
                    text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``text, label, fold`` of about ``rows`` labelled documents at most; ``fold`` is a hash modulo five.

    Of several labels of a document the largest counts; NULL labels and ids teach nothing. The sampled labels are
    broadcast: their number is bounded by ``rows``, so the documents are read once and not shuffled.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull() & learn).groupBy(
        F.col(doc_id).alias("label_id")).agg(F.max(label).cast("int").alias("label"))
    chosen = bounded_sample(known, ["label_id"], rows)
    return docs.select(F.col(doc_id).alias("own_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).join(
        F.broadcast(chosen), F.col("own_id") == F.col("label_id")).select(
        "text", "label", F.pmod(F.xxhash64("own_id"), F.lit(5)).cast("int").alias("fold"))
