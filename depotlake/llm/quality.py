"""Quality classifier: random-indexing word vectors, pooled, then a small calibrated network.

Every token has a sparse ternary index vector that its hash decides. The vector of a token is the sum of the
index vectors of its neighbours in a bounded sample of labelled documents; the form of a token (case, digits,
length) gets one in the same way and stands in for tokens outside the kept vocabulary. A document is the mean of
its tokens' vectors, the mean product of neighbouring vectors and a few shares (distinct, repeated, forms). A
two-layer network learns from these, and a temperature fitted on a fifth of the sample calibrates it.

``MAX_DOCS`` bounds the sample, ``MAX_WORDS`` the vocabulary; both are parameters. Sums are integers and every
choice is ordered, so the same table gives the same model.

Defined results: NULL, empty and white texts have all features zero and get the network's score for them. With
no labels at all every score is 0.5. Repeated rows get the same score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotlake.llm.common import settled

MAX_DOCS = 6_000
MAX_WORDS = 20_000
SIZE = 32
WINDOW = 2
HIDDEN = 32
EPOCHS = 60
SHARES = 6
FARTHEST = 5.0
POOLED_TOKENS = 1 << 16

_tokens = re.compile(r"\w+|[^\w\s]+").findall


def index_vector(token: str) -> np.ndarray:
    """Four entries of plus or minus one, at places that the token's hash gives."""
    bits, vector = xxhash.xxh64_intdigest(token.encode("utf-8", "replace")), np.zeros(SIZE, np.int64)
    for k in range(4):
        part = bits >> 16 * k
        vector[part % SIZE] += 1 if part & 0x8000 else -1
    return vector


def form(token: str) -> str:
    """The form of a token; a NUL in front keeps forms apart from tokens."""
    if token.isdigit():
        kind = "9"
    elif not any(c.isalnum() for c in token):
        kind = token[:3]
    elif token.isupper():
        kind = "A"
    elif token.islower():
        kind = "a"
    else:
        kind = "Aa"
    return f"\0{kind}{min(len(token), 16) // 4}"


def context_sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each token's and form's neighbours, summed over one partition of the sample."""
    place: dict[str, int] = {}
    forms = np.zeros(1024, np.int64)
    index, sums, counts = np.zeros((1024, SIZE), np.int64), np.zeros((1024, SIZE), np.int64), np.zeros(1024, np.int64)

    def row(name: str) -> int:
        nonlocal forms, index, sums, counts
        at = place.get(name)
        if at is None:
            at = place[name] = len(place)
            if at == len(counts):
                forms, index, sums, counts = (np.concatenate([x, np.zeros_like(x)])
                                              for x in (forms, index, sums, counts))
            index[at] = index_vector(name)
            forms[at] = at if name[0] == "\0" else row(form(name))
        return at

    for frame in frames:
        for text in frame["text"]:
            ids = np.array([row(token) for token in _tokens(text)], np.int64)
            vectors = index[ids]
            around = np.zeros_like(vectors)
            for shift in range(1, WINDOW + 1):
                around[shift:] += vectors[:-shift]
                around[:-shift] += vectors[shift:]
            for rows in (ids, forms[ids]):
                np.add.at(sums, rows, around)
                np.add.at(counts, rows, 1)
    names = list(place)
    for k in range(0, len(names), 4096):
        end = min(k + 4096, len(names))
        yield pd.DataFrame({"term": names[k:end], "n": counts[k:end], "v": list(sums[k:end])})


@dataclass
class QualityModel:
    words: dict[str, int]
    vectors: np.ndarray                # the last row, all zero, is for what is not known at all
    center: np.ndarray
    spread: np.ndarray
    layers: list[np.ndarray]           # weights and offsets of both layers
    temperature: float

    def score(self, features: np.ndarray) -> np.ndarray:
        if not self.layers:
            return np.full(len(features), 0.5)
        logits = _forward(self.layers, _standard(features, self.center, self.spread))[1]
        return 1 / (1 + np.exp(-np.clip(logits / self.temperature, -40, 40)))


class Pooler:
    """Features of texts; the rows of words of late are kept, up to a fixed number."""

    def __init__(self, words: dict[str, int], vectors: np.ndarray):
        self.words, self.vectors = words, vectors.astype(np.float32)
        self.seen: dict[str, tuple[int, int]] = {}

    def _row(self, token: str) -> tuple[int, int]:
        """The vector's row and the kind of form: 1 capital, 2 sign, 3 digits, 0 else."""
        shape = form(token)
        row = self.words.get(token, self.words.get(shape, len(self.vectors) - 1))
        kind = 3 if shape[1] == "9" else 1 if shape[1] == "A" and shape[2:3] != "a" else 0
        found = row, kind if token[0].isalnum() or kind else 2
        if len(self.seen) >= 300_000:
            self.seen.clear()
        self.seen[token] = found
        return found

    def features(self, text: str | None) -> np.ndarray:
        out = np.zeros(2 * SIZE + SHARES)
        tokens = _tokens(text) if text else []
        count = len(tokens)
        if not count:
            return out
        seen = self.seen.get
        pairs = [seen(token) or self._row(token) for token in tokens]
        rows, kinds = np.array(pairs, np.int32).T
        for k in range(0, count, POOLED_TOKENS):
            vectors = self.vectors[rows[k:k + POOLED_TOKENS + 1]]
            out[:SIZE] += vectors[:POOLED_TOKENS].sum(axis=0)
            out[SIZE:2 * SIZE] += (vectors[1:] * vectors[:-1]).sum(axis=0)
        out[:2 * SIZE] /= count
        again = sum(map(str.__eq__, tokens, tokens[1:])) / count
        out[2 * SIZE:] = (np.log1p(count), len(set(tokens)) / count, again,
                          *(np.bincount(kinds, minlength=4)[1:4] / count))
        return out


def _standard(features: np.ndarray, center: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Features in spreads from their mean; beyond ``FARTHEST`` all count alike, as nothing was learnt there."""
    return np.clip((features - center) / spread, -FARTHEST, FARTHEST)


def _forward(layers: list[np.ndarray], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inner = np.tanh(x @ layers[0] + layers[1])
    return inner, inner @ layers[2] + layers[3]


def train_network(x: np.ndarray, y: np.ndarray, seed: int = 7) -> list[np.ndarray]:
    """Cross-entropy by Adam with a little weight decay."""
    rng = np.random.default_rng(seed)
    layers = [rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
              rng.normal(0, HIDDEN ** -0.5, HIDDEN), np.zeros(1)]
    first, second = [np.zeros_like(p) for p in layers], [np.zeros_like(p) for p in layers]
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for k in range(0, len(x), 128):
            rows = order[k:k + 128]
            inner, logits = _forward(layers, x[rows])
            error = (1 / (1 + np.exp(-np.clip(logits, -40, 40))) - y[rows]) / len(rows)
            back = np.outer(error, layers[2]) * (1 - inner * inner)
            slopes = [x[rows].T @ back + 1e-4 * layers[0], back.sum(axis=0),
                      inner.T @ error + 1e-4 * layers[2], np.array([error.sum()])]
            step += 1
            for p, slope, m, v in zip(layers, slopes, first, second):
                m += 0.1 * (slope - m)
                v += 0.001 * (slope * slope - v)
                p -= 0.003 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return layers


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least cross-entropy on rows the network has not learnt from."""
    choices = np.geomspace(0.25, 8, 61)
    losses = [np.mean(np.logaddexp(0, np.where(y == 1, -1, 1) * logits / t)) for t in choices]
    return float(choices[int(np.argmin(losses))])


def learn(sample: DataFrame) -> QualityModel:
    """The model of a bounded labelled sample ``text, label, fold``; only vectors and features reach the driver."""
    sample = settled(sample, "sample")
    summed = sample.mapInPandas(context_sums, "term string, n long, v array<long>").groupBy("term").agg(
        F.sum("n").alias("n"), *[F.sum(F.col("v")[k]).alias(f"v{k}") for k in range(SIZE)])
    top = summed.orderBy(F.desc("n"), "term").limit(MAX_WORDS).toPandas()
    words = {term: k for k, term in enumerate(top["term"])}
    vectors = top[[f"v{k}" for k in range(SIZE)]].to_numpy(float)
    length = np.sqrt((vectors ** 2).sum(axis=1, keepdims=True))
    vectors = np.concatenate([vectors / np.maximum(length, 1e-9), np.zeros((1, SIZE))])
    features = sample.select(featured(F.col("text"), words, vectors, sample.sparkSession).alias("x"),
                             "label", "fold").toPandas()
    none = QualityModel(words, vectors, np.zeros(1), np.ones(1), [], 1.0)
    if features.empty:
        return none
    features["order"] = [tuple(x) for x in features["x"]]
    features = features.sort_values(["fold", "label", "order"])
    x, y = np.array(features["x"].tolist(), float), features["label"].to_numpy(float)
    fitted = features["fold"].to_numpy() != 0
    if not fitted.any() or fitted.all():
        fitted = np.ones(len(y), bool)
    center, spread = x[fitted].mean(axis=0), x[fitted].std(axis=0) + 1e-6
    x = _standard(x, center, spread)
    layers = train_network(x[fitted], y[fitted])
    rest = ~fitted if (~fitted).any() else fitted
    logits = _forward(layers, x[rest])[1]
    return QualityModel(words, vectors, center, spread, layers, fit_temperature(logits, y[rest]))


def featured(text: Column, words: dict[str, int], vectors: np.ndarray, spark) -> Column:
    sent = spark.sparkContext.broadcast((words, vectors))
    state: dict[str, Pooler] = {}

    @F.pandas_udf("array<double>")
    def features(texts: pd.Series) -> pd.Series:
        if "own" not in state:
            state["own"] = Pooler(*sent.value)
        return pd.Series([state["own"].features(text) for text in texts])

    return features(text)


def scored(text: Column, model: QualityModel, spark) -> Column:
    """The probability that a text is of label 1."""
    sent = spark.sparkContext.broadcast(model)
    state: dict[str, Pooler] = {}

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        if "own" not in state:
            state["own"] = Pooler(sent.value.words, sent.value.vectors)
        features = np.array([state["own"].features(text) for text in texts]).reshape(len(texts), -1)
        return pd.Series(sent.value.score(features) if len(texts) else [], dtype=float)

    return score(text)
