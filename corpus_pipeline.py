"""From documents to token ids in five stages, each over all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depotlake.llm import bpe, decontaminate, jaccard, language, secrets
from depotlake.llm.common import fresh, shipped, table
from depotlake.llm.queries import TOKENIZER
from depotlake.session import workspace

LEAST_LANGUAGE_SCORE = 0.5


@shipped
def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known: texts without letters and undecided ones go.

    The model is learnt from the labels of the documents themselves.
    """
    model = language.learn(docs, sample_keys=["doc_id"])
    best = fresh(docs, "best")
    rows = docs.withColumn(best, language.predicted(F.col("text"), model, spark))
    sure = (F.col(best)["lang_pred"] != language.UNKNOWN) & (F.col(best)["score"] >= LEAST_LANGUAGE_SCORE)
    return rows.where(sure).drop(best)


@shipped
def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a 5-word Jaccard similarity of 0.8 or more, the one with the least id stays.

    Candidates are the pairs of SimHash fingerprints within 4 bits, from the index of op4, and those of an index of shingle
    prefixes, as fingerprints of a few differing bits miss most copies at 0.8; whole sets decide on both. Rows of one id with unlike texts stand for their own groups, of repeated
    rows one stays, rows without id stay, texts without words are alike.
    """
    return jaccard.one_of_each_group(docs)


@shipped
def drop_benchmark_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of ``benchmark`` go; NULL and empty texts hold none, repeated rows go or stay alike."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


@shipped
def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced; lengths follow. No document goes."""
    clean = secrets.redacted(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in clean.columns else clean


@shipped
def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, lang, source, n_tokens, ids`` of every document, repeated rows too; NULL and empty texts have no ids."""
    ids = docs.select("doc_id", "lang", "source", bpe.encoded(F.col("text"), TOKENIZER).alias("ids"))
    return ids.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("language_id", keep_known_languages),
    ("simhash_dedup", keep_one_of_each_group),
    ("decontamination", drop_benchmark_texts),
    ("secret_scan", mask_secrets),
    ("bpe_encoding", encode_texts),
]

# Fingerprints need XXH64 and tokens need byte-pair merges, which SQL lacks; tests/llm holds the brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = workspace(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
