"""Removal of passages that recur: every window of ``WINDOW`` words that also starts anywhere else.

1. Runs. A window's anchor is the least hash of the ``GRAM``-word phrases in it, so equal windows have equal
   anchors wherever they stand. A run is a stretch of windows of one anchor; a text has about one run for
   ``SPAN`` / 2 words. Only anchors, hashes and places of runs are shuffled, not words.
2. Confirmed passages. A run whose anchor occurs once cannot recur (unless it repeats within itself). Of the others,
   runs that are equal as a whole are confirmed by counting. What is left are edges: runs that differ somewhere but
   may share windows, where a passage begins or ends.
3. Automata. The words of edges, and of one run of each confirmed passage beside them, are routed to shards by
   anchor. A shard confirms the windows that occur twice, compiles them into an Aho-Corasick automaton over word
   numbers, and streams its segments through it, which compares words, not hashes, and locates every occurrence.
4. Removal. Each document is streamed once with the runs and windows found for it.

An anchor with more than ``HOT`` runs is cut into single windows that are dealt out by their hash, so a phrase that a
third of all documents share does not meet in one shard; a shard holds the distinct windows of one anchor, never
its documents.

Defined results: windows are judged on the input. NULL and empty texts have no words. Rows without id are documents,
too. Repeated rows are occurrences of each other; what is found for them is kept once, not once for each. Documents are
known by a hash of id and text.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotlake.llm.common import settled

WINDOW = 35
GRAM = 8
SPAN = WINDOW - GRAM + 1
HOT = 5_000
BLOCK_ROWS = 2_000
WHOLE, EDGE, SAMPLE = 0, 1, 2

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _powers(base: np.uint64, count: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(count, base, np.uint64)]))


def _sliding_least(values: np.ndarray, span: int) -> np.ndarray:
    size = 1
    while size * 2 <= span:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = span - size
    return np.minimum(values[:len(values) - rest], values[rest:]) if rest else values


def runs(text: str | None) -> list[np.ndarray]:
    """``anchor, seg, start, n, again`` of the runs of a text: places in words, ``again`` if the anchor recurs inside."""
    words = text.encode("utf-8", "replace").split() if text else []
    if len(words) < WINDOW:
        return [np.zeros(0, np.int64)] * 5
    digest = xxhash.xxh3_64_intdigest
    hashes = _mixed(np.array(list(map(digest, words)), np.uint64))
    count = len(words)
    grams = hashes[:count - GRAM + 1].copy()
    for k in range(1, GRAM):
        grams *= _FACTOR
        grams += hashes[k:count - GRAM + 1 + k]
    grams = _mixed(grams)
    least = _sliding_least(grams, SPAN)
    start = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
    n = np.diff(np.concatenate([start, [len(least)]]))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * _powers(_FACTOR, count - 1))])
    whole = (sums[start + n + WINDOW - 1] - sums[start]) * _powers(_INVERSE, count)[start]
    seg = _mixed(whole ^ n.astype(np.uint64) * _FACTOR)
    lengths = n + SPAN - 1
    offsets = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    inside = np.repeat(start - offsets, lengths) + np.arange(lengths.sum())
    again = np.add.reduceat(grams[inside] == np.repeat(least[start], lengths), offsets, dtype=np.int64) > 1
    return [least[start].view(np.int64), seg.view(np.int64), start, n, again]


def _runs_of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for low in range(0, len(frame), 500):
            part = frame.iloc[low:low + 500]
            found = [runs(text) for text in part["text"]]
            columns = [np.concatenate(x) for x in zip(*found)]
            yield pd.DataFrame({
                "key": np.repeat(part["key"].to_numpy(), [len(x[0]) for x in found]),
                "anchor": columns[0], "seg": columns[1], "start": columns[2].astype(np.int32),
                "n": columns[3].astype(np.int32), "again": columns[4].astype(bool)})


def _segments_of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The words of edges and samples; those of hot anchors window by window, with a salt."""
    names = ["anchor", "salt", "key", "start", "n", "sample", "words"]
    for frame in frames:
        out = []
        for key, text, listed in zip(frame["key"], frame["text"], frame["runs"]):
            if listed is None or not any(run["role"] != WHOLE for run in listed):
                continue
            words = _split(text)
            for run in listed:
                if run["role"] == WHOLE:
                    continue
                anchor, start, n, sample = run["anchor"], run["start"], run["n"], run["role"] == SAMPLE
                if run["alike"] <= HOT:
                    out.append((anchor, 0, key, start, n, sample, " ".join(words[start:start + n + WINDOW - 1])))
                    continue
                salts, known = run["alike"] // HOT + 1, {}
                for at in range(start, start + n):
                    window = " ".join(words[at:at + WINDOW])
                    if window not in known:
                        known[window] = at
                        salt = xxhash.xxh64_intdigest(window.encode("utf-8", "replace")) % salts
                        out.append((anchor, salt, key, at, 1, sample, window))
                    elif not sample:               # recurs within the run: both places are located
                        out.extend((anchor, 0, key, place, 1, False, None) for place in (known[window], at))
            if len(out) > 20_000:
                yield pd.DataFrame(out, columns=names)
                out = []
        if out:
            yield pd.DataFrame(out, columns=names)


def _split(text: str) -> list[str]:
    """Words between ASCII white space; other white space belongs to words."""
    return [word.decode("utf-8", "replace") for word in text.encode("utf-8", "replace").split()]


class Shards:
    """Confirms windows and locates them, for segments sorted by anchor and salt."""

    def __init__(self):
        self.seen: dict[tuple, dict[tuple, tuple | None]] = {}
        self.block = 0

    def locate(self, rows: list[tuple]) -> list[tuple]:
        """``key, start, n`` of all located windows of one block of ``(group, key, start, sample, words)``."""
        self.block += 1
        found: list[tuple] = []
        patterns: set[tuple] = set()
        for group, key, start, sample, words in rows:
            seen = self.seen.setdefault(group, {})
            for at in range(len(words) - WINDOW + 1):
                window = tuple(words[at:at + WINDOW])
                if window in seen or sample:
                    first = seen.get(window)
                    if first is not None and first[2] != self.block:
                        found.append((first[0], first[1], 1))
                    seen[window] = None
                    patterns.add(window)
                else:
                    seen[window] = key, start + at, self.block
        last = rows[-1][0]
        self.seen = {last: self.seen[last]}
        if not patterns:
            return found
        numbers: dict[str, int] = {}
        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        for window in patterns:
            automaton.add_word(tuple(numbers.setdefault(word, len(numbers) + 1) for word in window), 1)
        automaton.make_automaton()
        for _, key, start, sample, words in rows:
            if sample:
                continue
            sequence = tuple(numbers.get(word, 0) for word in words)
            low = high = -1
            for last, _ in automaton.iter(sequence):
                at = last - WINDOW + 1
                if at != high:
                    if high > low:
                        found.append((key, start + low, high - low))
                    low = at
                high = at + 1
            if high > low:
                found.append((key, start + low, high - low))
        return found


def _located(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    shards, waiting = Shards(), []

    def done(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=["key", "start", "n"]).astype({"start": "int32", "n": "int32"})

    for frame in frames:
        known = frame[frame["words"].isna()]
        if len(known):
            yield known[["key", "start", "n"]]
        for anchor, salt, key, start, sample, words in frame.loc[
                frame["words"].notna(), ["anchor", "salt", "key", "start", "sample", "words"]].itertuples(index=False):
            waiting.append(((anchor, salt), key, start, sample, words.split(" ")))
            if len(waiting) >= BLOCK_ROWS:
                found = shards.locate(waiting)
                waiting = []
                if found:
                    yield done(found)
    if waiting:
        found = shards.locate(waiting)
        if found:
            yield done(found)


def _kept(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        out = []
        for doc_id, text, listed, located in zip(frame["doc_id"], frame["text"], frame["runs"], frame["located"]):
            words = _split(text) if text else []
            change = np.zeros(len(words) + 1, np.int32)
            whole = [(run["start"], run["n"]) for run in (listed if listed is not None else ()) if run["role"] in (WHOLE, SAMPLE)]
            for start, n in whole + [(x["start"], x["n"]) for x in (located if located is not None else ())]:
                change[start] += 1
                change[start + n + WINDOW - 1] -= 1
            gone = np.cumsum(change[:-1]) > 0
            left = [words[k] for k in np.flatnonzero(~gone)] if gone.any() else words
            out.append((doc_id, len(words), len(words) - len(left), " ".join(left)))
        yield pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "kept"])


def without_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` of every row; kept words are joined by one blank."""
    rows = docs.select(F.xxhash64(doc_id, text).alias("key"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    kind = "key long, anchor long, seg long, start int, n int, again boolean"
    found = settled(rows.select("key", "text").mapInPandas(_runs_of, kind), "runs")
    anchors = found.groupBy("anchor").agg(F.count("*").alias("alike"), F.max("again").alias("inside")).where(
        "alike > 1 or inside").select("anchor", "alike")
    shared = settled(found.join(anchors, "anchor").where("alike > 1 or again"), "shared")
    segs = shared.groupBy("anchor", "seg").agg(
        F.count("*").alias("same"), F.min(F.struct("key", "start")).alias("first"))
    # A confirmed run is whole; its first place lends its words if other runs of the anchor are edges.
    role = F.when(F.col("same") == 1, EDGE).when(
        (F.col("same") < F.col("alike")) & (F.struct("key", "start") == F.col("first")), SAMPLE).otherwise(WHOLE)
    listed = shared.join(segs, ["anchor", "seg"]).select(
        "key", F.struct("anchor", "start", "n", role.alias("role"), "alike").alias("run")).groupBy("key").agg(
        F.collect_set("run").alias("runs"))
    listed = settled(listed, "listed")
    joined = rows.join(listed, "key", "left").select("key", "doc_id", "text", "runs")
    segments = joined.mapInPandas(
        _segments_of, "anchor long, salt long, key long, start int, n int, sample boolean, words string")
    located = segments.repartition("anchor", "salt").sortWithinPartitions("anchor", "salt", F.desc("sample")).mapInPandas(
        _located, "key long, start int, n int")
    places = located.groupBy("key").agg(F.collect_set(F.struct("start", "n")).alias("located"))
    return joined.join(places, "key", "left").select("doc_id", "text", "runs", "located").mapInPandas(
        _kept, "doc_id long, n_words long, n_removed long, kept string")
