"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depotlake.llm import (
    bpe, decontaminate, language, licenses, quality, runs, secrets, simhash, substrings, tokencounts, topk, toxicity, whitening,
)
from depotlake.llm.common import held_out, learnable, shipped, table
from depotlake.llm.labelled import labelled_sample
from depotlake.llm.sql import LICENSES_SQL, SECRETS_SQL, TOPK_SQL

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
TOKEN_LIMIT = 512


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.learn(labelled_sample(docs, table(spark, sf_dir, "labels"), "quality",
                                          learnable("doc_id", 3, 1), quality.MAX_DOCS))
    return docs.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"),
                       quality.scored(F.col("text"), model, spark).alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item that a document holds with few edits."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.learn(docs.where(learnable("doc_id", 4, 2)), sample_keys=["doc_id"])
    best = F.col("best")
    return docs.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"),
                       language.predicted(F.col("text"), model, spark).alias("best")).select(
        "doc_id", "held_out", best["lang_pred"].alias("lang_pred"), best["score"].alias("score"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.learn(labelled_sample(docs, table(spark, sf_dir, "labels"), "toxic",
                                           learnable("doc_id", 4, 2), toxicity.MAX_DOCS))
    return docs.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"),
                       toxicity.scored(F.col("text"), model, spark).alias("found")).select(
        "doc_id", "held_out", F.col("found")["score"].alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.3).cast("int"))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licenses(table(spark, sf_dir, "documents"))


def op7_bpe(spark: SparkSession, sf_dir: str, vocabulary: str = TOKENIZER) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", bpe.round_trip(F.col("text"), vocabulary).alias("tokens"))
    ids = F.col("tokens")["ids"]
    return rows.select(
        "doc_id", F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", ids.cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("tokens")["text"], 256).alias("decoded_sha256"))


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    spans = secrets.with_spans(docs, "found").select("doc_id", "found")
    base = [rule.kind for rule in secrets.BASE_RULES]

    def number(kind: str):
        return F.size(F.filter("found", lambda span: span["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return spans.select(
        "doc_id", *map(number, base),
        F.sha2(secrets.listed(F.filter("found", lambda span: span["kind"].isin(base))), 256).alias("base_sha256"),
        secrets.listed(F.col("found")).alias("spans"))


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.without_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``docs`` in which every tenth text by hash of its id goes on from a word of it with a period."""
    stamp = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split(F.col("text"), r"[\x20\x09-\x0D]+"), lambda word: word != "")
    rows = docs.withColumn("stamp", stamp).withColumn("words", F.when(F.col("stamp") % 10 == 0, words))
    g, n = F.floor(F.col("stamp") / 10), F.size("words")
    rows = rows.withColumn("first", F.when(n > 0, g % n).cast("int"))
    share = (3 + g % 8).cast("int")
    period = (1 + F.floor((n - F.col("first")) / share)).cast("int")
    tail = F.flatten(F.array_repeat(F.slice("words", F.col("first") + 1, period), share))
    planted = F.concat(F.slice("words", F.lit(1), F.col("first")), F.slice(tail, F.lit(1), n - F.col("first")))
    return rows.withColumn("text", F.when(F.col("first").isNotNull(), F.array_join(planted, " ")).otherwise(
        F.col("text"))).drop("stamp", "words", "first")


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_planted_runs(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = runs.with_runs(docs).select("doc_id", "runs", "collapsed")
    longest = F.array_max(F.transform("runs", lambda run: F.struct(
        run["length"].alias("length"), (-run["start"]).alias("start"), (-run["period"]).alias("period"))))
    lines = F.transform("runs", lambda run: F.concat(
        *[part for name in ("start", "length", "period") for part in (run[name].cast("string"), F.lit(","))][:-1], F.lit("\n")))
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("longest"),
                        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", (-F.col("longest")["start"]).alias("start"), F.col("longest")["length"].alias("length"),
        (-F.col("longest")["period"]).alias("period"),
        F.floor(1000 * F.col("longest")["length"] / -F.col("longest")["period"]).cast("long").alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256")


def op13_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.octet_length(text).cast("long").alias("n_bytes"),
        tokencounts.n_tokens(F.col("text"), TOKENIZER).alias("n_tokens")).withColumn(
        "over_limit", F.col("n_tokens") > TOKEN_LIMIT)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {query.__name__: shipped(query) for query in (
    op1_quality, op2_decontaminate, op3_language, op4_simhash, op5_toxicity, op6_licenses, op7_bpe, op8_topk,
    op9_secrets, op10_substrings, op11_whitening, op12_runs, op13_tokens)}

ORACLES: dict[str, str] = {
    "op6_licenses": LICENSES_SQL,
    "op8_topk": TOPK_SQL,
    "op9_secrets": SECRETS_SQL,
}
