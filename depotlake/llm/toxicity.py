"""Toxicity from a learnt lexicon, Levenshtein automata and context windows.

The lexicon is learnt from a bounded sample of labelled documents: words, and stems that many different words
begin with, that occur in toxic documents far beyond chance. What counts is in how many different places, told by the
words around them, so that copies of one document do not make its words a lexicon. Its trie is intersected with a Levenshtein automaton,
lazily and once for all words: a state is the set of trie nodes with the edits spent on the way there, so most
words leave it after two or three letters. Words within the edits that a term's length allows count as misspelt
terms, unless clean documents use them.

Each hit is weighed by its window: inside quotation marks, or near words of reporting, it counts as quoted, not as
abuse. A logistic model over both kinds of hits gives the score.

``MAX_DOCS`` bounds the sample, ``MAX_TERMS`` the lexicon. Defined results: NULL, empty and white texts have no hits
and get the score of a text without any. With nothing to learn from every score is 0.5 or the share of toxic
labels. Repeated rows get the same score.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotlake.llm.common import settled

MAX_DOCS = 12_000
MAX_TERMS = 1_000
MAX_CLEAN_WORDS = 20_000
STEM_LETTERS = (4, 5, 6, 7)
TOXIC_SHARE = 0.9
CHANCE = 0.01
WINDOW = 6
CACHED_WORDS = 250_000
STEM = "*"
HITS = "score double, hits array<struct<term:string,word:string,edits:int,word_at:int,quoted:boolean>>"

# Fixed: words that announce somebody else's words.
REPORTING = frozenset("said says wrote writes quote quoted quotes called calls reported reports dijo dice citó "
                      "sagte sagt schrieb zitat zitiert dit disait écrit citation cité".split())
_tokens = re.compile(r"[\"“”„«»]|[^\W_]+").findall
_MARKS = frozenset("\"“”„«»")


def edits_allowed(term: str) -> int:
    """None up to four letters and in stems, one up to eight, two beyond."""
    if term.endswith(STEM) or len(term) <= 4:
        return 0
    return 1 if len(term) <= 8 else 2


class LexiconAutomaton:
    """Levenshtein automata of all terms at once, over the trie of the lexicon."""

    def __init__(self, terms: list[str]):
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[list[str]] = [[]]
        self.allowed = [0]
        for term in sorted(terms):
            node = 0
            self.allowed[0] = max(self.allowed[0], edits_allowed(term))
            for letter in term.removesuffix(STEM):
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.ends.append([])
                    self.allowed.append(0)
                node = self.children[node][letter]
                self.allowed[node] = max(self.allowed[node], edits_allowed(term))
            self.ends[node].append(term)
        self.letters = {letter for children in self.children for letter in children}
        self.numbers: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.steps: list[dict[str, int]] = []
        self.found: list[tuple[str, int] | None] = []
        self.start = self._number({(0, 0)})

    def _number(self, pairs: set[tuple]) -> int:
        """The state of these (node, edits) pairs, after letters of the term are skipped; -1 if none is left."""
        least: dict = {}
        waiting = list(pairs)
        while waiting:
            node, edits = waiting.pop()
            if isinstance(node, str):
                least[node] = 0
            elif edits <= self.allowed[node] and edits < least.get(node, 99):
                least[node] = edits
                waiting.extend((child, edits + 1) for child in self.children[node].values())
                waiting.extend((term, 0) for term in self.ends[node] if term.endswith(STEM) and not edits)
        if not least:
            return -1
        key = frozenset(least.items())
        if key not in self.numbers:
            self.numbers[key] = len(self.sets)
            self.sets.append(key)
            self.steps.append({})
            hits = [(edits, node) for node, edits in least.items() if isinstance(node, str)]
            hits += [(edits, term) for node, edits in least.items() if not isinstance(node, str)
                     for term in self.ends[node] if not term.endswith(STEM) and edits <= edits_allowed(term)]
            self.found.append(min(hits)[::-1] if hits else None)
        return self.numbers[key]

    def _step(self, state: int, letter: str) -> int:
        pairs: set[tuple] = set()
        for node, edits in self.sets[state]:
            if isinstance(node, str):
                pairs.add((node, 0))
                continue
            for other, child in self.children[node].items():
                pairs.add((child, edits + (other != letter)))
            pairs.add((node, edits + 1))
        return self._number(pairs)

    def match(self, word: str) -> tuple[str, int] | None:
        """The nearest term and its edits; of equally near ones the term that sorts first."""
        state = self.start
        for letter in word:
            letter = letter if letter in self.letters else ""
            following = self.steps[state].get(letter)
            if following is None:
                following = self.steps[state][letter] = self._step(state, letter)
            if following < 0:
                return None
            state = following
        return self.found[state]


@dataclass
class ToxicityModel:
    terms: list[str]
    clean_words: frozenset[str]        # near a term, but used by clean documents
    weights: np.ndarray                # offset, abusive hits, quoted hits, misspelt hits, density

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.weights[0] + features @ self.weights[1:], -40, 40)))


class Scanner:
    """Finds the hits of one lexicon; words of late are kept in two generations of fixed size."""

    def __init__(self, terms: list[str], clean_words: frozenset[str]):
        self.automaton, self.clean_words = LexiconAutomaton(terms), clean_words
        self.young: dict[str, tuple | None] = {}
        self.old: dict[str, tuple | None] = {}

    def _known(self, word: str) -> tuple[str, int] | None:
        return self.young[word] if word in self.young else self._match(word)

    def _match(self, word: str) -> tuple[str, int] | None:
        if word in self.old:
            found = self.old[word]
        else:
            found = self.automaton.match(word)
            if found and found[1] and word in self.clean_words:
                found = None
        if len(self.young) >= CACHED_WORDS:
            self.old, self.young = self.young, {}
        self.young[word] = found
        return found

    def hits(self, text: str | None) -> tuple[list[dict], int]:
        """The hits of a text and its number of tokens."""
        tokens = _tokens(text.lower()) if text else []
        hit_of = {token: hit for token in set(tokens) if (hit := self._known(token))}
        found = [(at, hit_of[token]) for at, token in enumerate(tokens) if token in hit_of] if hit_of else []
        if not found:
            return [], len(tokens)
        opened = np.cumsum([token in _MARKS for token in tokens])
        out = []
        for at, (term, edits) in found:
            before, after = tokens[max(0, at - WINDOW):at], tokens[at + 1:at + 1 + WINDOW]
            marked = opened[at] % 2 == 1 or (not _MARKS.isdisjoint(before) and not _MARKS.isdisjoint(after))
            out.append({"term": term, "word": tokens[at], "edits": edits, "word_at": at,
                        "quoted": bool(marked or not REPORTING.isdisjoint(before))})
        return out, len(tokens)

    def features(self, text: str | None) -> tuple[list[float], list[dict]]:
        hits, count = self.hits(text)
        quoted = sum(hit["quoted"] for hit in hits)
        bent = sum(hit["edits"] > 0 for hit in hits)
        plain = len(hits) - quoted
        return [math.log1p(plain), math.log1p(quoted), math.log1p(bent), min(1.0, 20 * plain / max(1, count))], hits


def _terms(sample: DataFrame) -> tuple[DataFrame, float]:
    """``term, toxic, clean``: different places of a word or stem in documents of either label; and the share of
    toxic ones among all places."""
    words = F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    placed = sample.select("label", words.alias("words")).select(
        "label", "words", F.posexplode("words").alias("at", "term")).select(
        "label", "term", F.xxhash64(F.get("words", F.col("at") - 1), F.get("words", F.col("at") + 1)).alias("place"))
    by_word = settled(placed.distinct().groupBy("term").agg(
        F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean")), "places")
    stems = by_word.select(F.explode(F.array(*[F.when(F.length("term") >= size, F.concat(
        F.substring("term", 1, size), F.lit(STEM))) for size in STEM_LETTERS])).alias("term"), "toxic", "clean").where(
        "term is not null").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    total = by_word.agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).first()
    share = (total["toxic"] or 0) / max(1, (total["toxic"] or 0) + (total["clean"] or 0))
    return settled(by_word.union(stems).where("toxic + clean >= 2"), "terms"), float(share)


def learn_lexicon(counted: DataFrame, share: float) -> list[str]:
    """Terms in so many places of toxic documents that chance is ruled out.

    Words stay beside a stem that covers them, as only they allow edits. Stems that stand for a single word, or begin with another stem, are taken out before the most frequent are chosen.
    """
    if not 0 < share < 1:
        return []
    least = math.log(max(2, counted.count()) / CHANCE) / -math.log(share)
    rows = settled(counted.where((F.col("toxic") >= least) & (
        F.col("toxic") >= TOXIC_SHARE * (F.col("toxic") + F.col("clean")))), "toxic_terms")
    is_stem = F.endswith("term", F.lit(STEM))
    words, stems = rows.where(~is_stem), rows.where(is_stem)

    def beginnings(terms: DataFrame, shorter: bool = False) -> DataFrame:
        letters = F.length("term") - int(shorter)
        return terms.select("term", F.explode(F.filter(F.array(*[F.when(letters >= size + int(shorter), F.concat(
            F.substring("term", 1, size), F.lit(STEM))) for size in STEM_LETTERS]), F.isnotnull)).alias("stem"))

    single = beginnings(words).groupBy("stem").count().where("count = 1").select(F.col("stem").alias("term"))
    stems = stems.join(single, "term", "left_anti")
    known = stems.select(F.col("term").alias("stem"))
    covered = beginnings(stems, True).join(known, "stem").select("term")
    return sorted(row["term"] for row in stems.union(words).join(covered, "term", "left_anti").orderBy(
        F.desc("toxic"), "clean", "term").limit(MAX_TERMS).collect())


def learn(sample: DataFrame) -> ToxicityModel:
    """The model of a bounded labelled sample ``text, label, fold``."""
    sample = settled(sample, "sample")
    counted, share = _terms(sample)
    terms = learn_lexicon(counted, share)
    state: dict[str, LexiconAutomaton] = {}

    @F.pandas_udf("boolean")
    def bent(words: pd.Series) -> pd.Series:
        if "own" not in state:
            state["own"] = LexiconAutomaton(terms)
        return pd.Series([bool((hit := state["own"].match(word)) and hit[1]) for word in words], dtype=bool)

    near = counted.where((F.col("clean") > F.col("toxic")) & ~F.endswith("term", F.lit(STEM))).where(bent("term"))
    clean_words = frozenset(row["term"] for row in near.orderBy(F.desc("clean"), "term").limit(MAX_CLEAN_WORDS).collect())
    state2: dict[str, Scanner] = {}

    @F.pandas_udf("array<double>")
    def features(texts: pd.Series) -> pd.Series:
        if "own" not in state2:
            state2["own"] = Scanner(terms, clean_words)
        return pd.Series([state2["own"].features(text)[0] for text in texts])

    rows = sample.select(features("text").alias("x"), "label").groupBy("x", "label").count().collect()
    return ToxicityModel(terms, clean_words, _fit(sorted((tuple(r["x"]), r["label"], r["count"]) for r in rows)))


def _fit(rows: list[tuple]) -> np.ndarray:
    """Logistic regression by Newton steps with a ridge; weights of abusive hits cannot be negative."""
    weights = np.zeros(5)
    if not rows:
        return weights
    x = np.array([[1.0, *features] for features, _, _ in rows])
    y, n = np.array([label for _, label, _ in rows], float), np.array([count for _, _, count in rows], float)
    ridge = np.diag([0.01, 0.1, 0.1, 0.1, 0.1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (n * (p - y)) + ridge @ weights
        bend = (x * (n * p * (1 - p))[:, None]).T @ x + ridge
        step = np.linalg.solve(bend, slope)
        weights -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    weights[[1, 4]] = np.maximum(weights[[1, 4]], 0)
    return weights


def scored(text: Column, model: ToxicityModel, spark) -> Column:
    """struct<score, hits> of each text."""
    sent = spark.sparkContext.broadcast(model)
    state: dict[str, Scanner] = {}

    @F.pandas_udf(HITS)
    def score(texts: pd.Series) -> pd.DataFrame:
        model = sent.value
        if "own" not in state:
            state["own"] = Scanner(model.terms, model.clean_words)
        parts = [state["own"].features(text) for text in texts]
        features = np.array([x for x, _ in parts]).reshape(len(parts), 4)
        return pd.DataFrame({"score": model.score(features), "hits": [hits for _, hits in parts]})

    return score(text)
