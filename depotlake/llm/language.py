"""Language identification, words first, then shorter and shorter character n-grams.

A known word counts with its log frequency in each language. An unseen word is cut into the longest n-grams of
which at least one is known, from ``LONGEST`` letters down to one, and counts with the mean of theirs. Runs of any length are
cut as a whole, piece by piece; only words of up to ``CACHED_LETTERS`` letters are kept for the next text. The sums
and the log share of each language give the prediction; its posterior is the score.

The model is learnt from a sample of at most about ``MAX_DOCS`` labelled documents and keeps the most frequent
``MAX_WORDS`` words and ``MAX_GRAMS`` n-grams, so what is sent to the executors has a fixed bound.

Defined results: NULL text or text without a letter is ``und`` with score 0, as is everything when there is nothing
to learn from. Letters of which no n-gram is known give the most frequent language. Ties go to the language that
sorts first. Repeated rows get the same prediction; labels that are NULL teach nothing.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotlake.llm.common import bounded_sample, settled

MAX_DOCS = 8_000
MAX_WORDS = 30_000
MAX_GRAMS = 60_000
LONGEST = 5
SMOOTHING = 0.5
PIECE = 256
CACHED_WORDS = 250_000
CACHED_LETTERS = 64
UNKNOWN = "und"

# Runs of letters, as learning takes them: first with digits that are no decimals ("m²"), which few words hold.
_tokens = re.compile(r"[^\W\d_]+").findall
_letters = regex.compile(r"\p{L}+").findall


def words_of(text: str) -> list[str]:
    words = _tokens(text.lower())
    return words if all(map(str.isalpha, words)) else [run for word in words for run in _letters(word)]


@dataclass
class LanguageModel:
    languages: list[str]
    prior: np.ndarray                  # log share of each language
    words: dict[str, int]              # row of ``scores``
    grams: dict[str, int]
    scores: np.ndarray                 # log frequency, one column for each language


def _log_table(rows: pa.Table, languages: list[str]) -> tuple[dict[str, int], np.ndarray]:
    """The row of each term and its log frequencies, of ``term, by_lang`` as Arrow columns: one object for each term
    and none for its counts, as the driver holds all of them."""
    by_lang = rows["by_lang"].combine_chunks()
    entries = by_lang.flatten()
    counts = np.zeros((len(rows), len(languages)))
    place = pc.index_in(entries.field("lang"), value_set=pa.array(languages, pa.string())).to_numpy(zero_copy_only=False)
    at = np.repeat(np.arange(len(rows)), pc.list_value_length(by_lang).to_numpy(zero_copy_only=False))
    counts[at, place] = entries.field("n").to_numpy(zero_copy_only=False)
    totals = counts.sum(axis=0) + SMOOTHING * max(1, len(rows))
    return {term: k for k, term in enumerate(rows["term"].to_pylist())}, np.log((counts + SMOOTHING) / totals)


def _pieces(word: Column) -> Column:
    """``word`` in pieces that overlap by ``LONGEST`` - 1 letters; a word of any length takes time in proportion."""
    parts = F.regexp_extract_all(word, F.lit(f".{{1,{PIECE}}}"), F.lit(0))
    return F.transform(parts, lambda part, k: F.concat(
        part, F.coalesce(F.substring(F.get(parts, k + 1), 1, LONGEST - 1), F.lit(""))))


def _grams(piece: Column, at: Column, size: int) -> Column:
    """The n-grams that start in the piece numbered ``at``; a word shorter than ``size`` is one."""
    last = F.least(F.lit(PIECE), F.length(piece) - (size - 1))
    starts = F.when((last >= 1) | (at == 0), F.sequence(F.lit(1), F.greatest(F.lit(1), last))).otherwise(
        F.array().cast("array<int>"))
    return F.transform(starts, lambda start: F.substring(piece, start, F.lit(size)))


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", sample_keys: list[str] | None = None,
          max_docs: int = MAX_DOCS) -> LanguageModel:
    """The model of the labelled ``docs``; counting is one aggregate, its most frequent terms are collected."""
    labelled = docs.where(F.col(lang).isNotNull())
    sample = bounded_sample(labelled, sample_keys or [text, lang], max_docs).select(
        F.col(lang).cast("string").alias("lang"), F.lower(F.col(text)).alias("text"))
    counted = settled(
        sample.select("lang", F.explode(F.regexp_extract_all("text", F.lit(r"\p{L}+"), F.lit(0))).alias("term"))
        .groupBy("lang", "term").agg(F.count("*").alias("n")), "words")
    languages = sorted(row["lang"] for row in counted.select("lang").distinct().collect())
    if not languages:
        return LanguageModel([], np.zeros(0), {}, {}, np.zeros((0, 0)))
    share = {row["lang"]: row["n"] for row in counted.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    padded = F.concat(F.lit(" "), "term", F.lit(" "))
    pieces = counted.select("lang", "n", F.posexplode(_pieces(padded)).alias("at", "piece"))
    cut = F.flatten(F.array(*[_grams(F.col("piece"), F.col("at"), size) for size in range(1, LONGEST + 1)]))
    grams = pieces.select("lang", "n", F.explode(cut).alias("term")).where("term <> ' '")

    def frequent(terms: DataFrame, limit: int):
        by_lang = terms.groupBy("term", "lang").agg(F.sum("n").alias("n")).groupBy("term").agg(
            F.sum("n").alias("total"), F.collect_list(F.struct("lang", "n")).alias("by_lang"))
        return by_lang.orderBy(F.desc("total"), "term").limit(limit).select("term", "by_lang").toArrow()

    words, word_scores = _log_table(frequent(counted, MAX_WORDS), languages)
    letters, gram_scores = _log_table(frequent(grams, MAX_GRAMS), languages)
    total = sum(share.values())
    prior = np.array([math.log(share[language] / total) for language in languages])
    return LanguageModel(languages, prior, words, {term: k + len(words) for term, k in letters.items()},
                         np.concatenate([word_scores, gram_scores]))


class Predictor:
    """Scores words of one model; unseen words of late are kept in two generations of fixed size."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self.zero = np.zeros(len(model.languages))
        self.known = {word: tuple(model.scores[k].tolist()) for word, k in model.words.items()}
        self.young: dict[str, tuple] = {}
        self.old: dict[str, tuple] = {}

    def unseen(self, word: str) -> tuple:
        if len(word) > CACHED_LETTERS:
            return self._by_grams(f" {word} ")
        found = self.old.get(word)
        if found is None:
            found = self._by_grams(f" {word} ")
        if len(self.young) >= CACHED_WORDS:
            self.old, self.young = self.young, {}
        self.young[word] = found
        return found

    def _by_grams(self, padded: str) -> tuple:
        """The mean of the longest n-grams of which one is known, over the whole run, piece by piece."""
        grams, scores = self.model.grams, self.model.scores
        for size in range(LONGEST, 0, -1):
            end, total, count = max(1, len(padded) - size + 1), self.zero, 0
            for at in range(0, end, PIECE):
                rows = [grams[gram] for k in range(at, min(end, at + PIECE)) if (gram := padded[k:k + size]) in grams]
                if rows:
                    total, count = total + scores[rows].sum(axis=0), count + len(rows)
            if count:
                return tuple((total / count).tolist())
        return ()

    def predict(self, text: str | None) -> tuple[str, float]:
        model = self.model
        words = words_of(text) if text and model.languages else []
        if not words:
            return UNKNOWN, 0.0
        known, young = self.known.get, self.young.get
        parts = []
        for word in words:
            scores = known(word)
            if scores is None:
                scores = young(word)
                if scores is None:
                    scores = self.unseen(word)
                    young = self.young.get
            if scores:
                parts.append(scores)
        total = model.prior + (np.array(parts).sum(axis=0) if parts else self.zero)
        best = int(np.argmax(total))
        return model.languages[best], float(1 / np.exp(total - total[best]).sum())


def predicted(text: Column, model: LanguageModel, spark) -> Column:
    """struct<lang_pred, score> for each text; the model is broadcast once."""
    sent = spark.sparkContext.broadcast(model)
    state: dict[str, Predictor] = {}

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        if "own" not in state:
            state["own"] = Predictor(sent.value)
        return pd.DataFrame([state["own"].predict(x) for x in texts], columns=["lang_pred", "score"])

    return predict(text)
