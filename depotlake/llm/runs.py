"""Periodic runs of words by a dictionary of basic factors.

A run is a stretch of words in which words q apart are equal, q being its smallest period, that is at least two
periods and ``least`` words long and that no word beside it continues.

For each power of two L, equal stretches of L words ("factors") of one text get one name, from the names of their
halves. The places of a name, in order, fall into progressions: a next place within L / 2 is one smallest period of the
factor away, so such places are evenly spaced. They propose periods:

* L <= length - q < 2L and q <= L: the first word of the run and the one q later begin successive places of one
  name, since a factor of at least one period occurs nowhere in between. Gaps within and between progressions are proposed.
* L < q < 2L: the places are in two progressions of one name, at most three further on. Unless both end at once or
  begin at once (the difference of the last or first places is q), each of the two evenly periodic stretches reaches
  over its end of the run, so that they touch; then all differences in steps of the common spacing are proposed.

Every proposal is extended to both sides by the names, longest first; of proposals with equal stretches the
smallest period stays. Nothing depends on how often words repeat: a progression counts once, whatever its length.

Texts are handled in blocks of ``BLOCK_WORDS`` words; a longer text is a block of its own. Places whose factor occurs
once in its text are dropped before the next power of two, so texts without repeats stop after a few rounds. Memory is
some 40 bytes a word, and 4 bytes for each power of two up to the longest stretch that repeats.

Defined results: NULL and texts without words have no runs and the empty text as collapsed one; repeated rows have
equal runs; the other columns stay, and new names give way to existing ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST = 12
BLOCK_WORDS = 1 << 18
#: Number of further progressions of a name that can lie within 2L, as they are more than L / 2 apart.
FURTHER = 3

RUN = "struct<start: bigint, length: bigint, period: bigint>"


class Factors:
    """Names of the factors of all powers of two of a block of texts; -1 where a factor occurs once in its text."""

    def __init__(self, words: np.ndarray, texts: np.ndarray, ends: np.ndarray):
        """``words``: number of each word; ``texts``: number of its text; ``ends``: end of that text in the block."""
        self.ends = ends
        self.names: list[np.ndarray] = []
        everywhere = np.arange(len(words))
        self._name(everywhere, texts.astype(np.int64) * (int(words.max(initial=0)) + 1) + words)

    def _name(self, places: np.ndarray, keys: np.ndarray) -> None:
        codes, _ = pd.factorize(keys)
        often = np.bincount(codes)[codes] > 1 if len(codes) else np.zeros(0, bool)
        names = np.full(len(self.ends), -1, np.int32)
        names[places[often]] = pd.factorize(codes[often])[0]
        self.names.append(names)

    def longer(self) -> bool:
        """Name the factors of the next power of two; False when none repeats."""
        last = self.names[-1]
        half = 1 << (len(self.names) - 1)
        places = np.flatnonzero(last >= 0)
        places = places[places + 2 * half <= self.ends[places]]
        places = places[last[places + half] >= 0]
        if not len(places):
            return False
        self._name(places, last[places].astype(np.int64) << 32 | last[places + half])
        return bool((self.names[-1] >= 0).any())

    def equal_after(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """How many words from ``left`` on equal those from ``right`` on."""
        count = np.zeros(len(left), np.int64)
        for level in range(len(self.names) - 1, -1, -1):
            self._step(level, left, right, count, 0)
        return count

    def equal_before(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """How many words before ``left`` equal those before ``right``."""
        count = np.zeros(len(left), np.int64)
        for level in range(len(self.names) - 1, -1, -1):
            self._step(level, left, right, count, 1 << level)
        return count

    def _step(self, level: int, left: np.ndarray, right: np.ndarray, count: np.ndarray, back: int) -> None:
        names, size = self.names[level], 1 << level
        # The longest factors may fit again and again, shorter ones once.
        going = np.arange(len(left))
        while len(going):
            sign = -1 if back else 1
            a, b = left[going] + sign * count[going] - back, right[going] + sign * count[going] - back
            inside = (a >= 0) & (b < len(names))
            going, a, b = going[inside], a[inside], b[inside]
            same = (names[a] >= 0) & (names[a] == names[b])
            going = going[same]
            count[going] += size
            if level < len(self.names) - 1:
                break

    def proposals(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and periods that the progressions of factors of 2^level words propose."""
        names, size = self.names[level], 1 << level
        places = np.flatnonzero(names >= 0)
        places = places[np.argsort(names[places], kind="stable")]
        owner = names[places]
        gap = np.diff(places)
        same = owner[1:] == owner[:-1]
        near = same & (gap <= size // 2)
        wide = same & ~near & (gap <= size)
        first = np.flatnonzero(np.r_[True, ~near])
        last = np.r_[first[1:], len(places)] - 1
        low, high, name = places[first], places[last], owner[first]
        many = last > first
        step = np.where(many, places[np.minimum(first + 1, len(places) - 1)] - low, 0)
        at, period = [low[many], places[:-1][wide]], [step[many], gap[wide]]
        for further in range(1, FURTHER + 1):
            here, there = np.arange(len(low) - further), np.arange(further, len(low))
            met = (name[here] == name[there]) & (low[there] - high[here] < 2 * size)
            here, there = here[met], there[met]
            for of in (low, high):
                at.append(of[here])
                period.append(of[there] - of[here])
            spacing = np.maximum(step[here], step[there])
            touching = (spacing > 0) & (low[there] <= high[here] + size + spacing - 1)
            here, there, spacing = here[touching], there[touching], spacing[touching]
            # Neither stretch is shorter than the period; differences below that of the nearest places do not occur.
            longest = np.minimum(np.minimum(high[here] - low[here], high[there] - low[there]) + size + spacing,
                                 np.minimum(2 * size - 1, high[there] - low[here]))
            nearest = low[there] - high[here]
            number = np.maximum(0, (longest - nearest) // spacing + 1)
            which = np.repeat(np.arange(len(number)), number)
            rank = np.arange(len(which)) - np.repeat(np.cumsum(number) - number, number)
            q = nearest[which] + rank * spacing[which]
            at.append(np.maximum(low[here][which], low[there][which] - q))
            period.append(q)
        at, period = np.concatenate(at), np.concatenate(period)
        good = (period > 0) & (period < 2 * size)
        return at[good], period[good]


def runs_of(words: np.ndarray, texts: np.ndarray, ends: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Rows of start, end and period of all runs of a block, by start, then period."""
    if not len(words):
        return np.zeros((0, 3), np.int64)
    factors = Factors(words, texts, ends)
    at, period = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    # A run's length less its period is least / 2 or more, so shorter factors need propose nothing.
    lowest = max(1, -(-least // 2)).bit_length() - 1
    level = 0
    while True:
        if level >= lowest:
            places, periods = factors.proposals(level)
            at.append(places)
            period.append(periods)
        if not factors.longer():
            break
        level += 1
    proposed = np.unique(np.concatenate(period) * len(words) + np.concatenate(at))
    q, i = np.divmod(proposed, len(words))
    end = i + q + factors.equal_after(i, i + q)
    start = i - factors.equal_before(i, i + q)
    long = end - start >= np.maximum(least, 2 * q)
    found = np.stack([start[long], end[long], q[long]], axis=1)
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    # Of equal stretches the smallest period comes first.
    new = np.r_[True, (found[1:, :2] != found[:-1, :2]).any(axis=1)] if len(found) else np.zeros(0, bool)
    found = found[new]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def _found(texts: list[list[bytes]], least: int) -> Iterator[tuple[np.ndarray, bytes]]:
    """Runs of each text, and the text without the words that its runs repeat."""
    sizes = np.array([len(words) for words in texts], np.int64)
    every = [word for words in texts for word in words]
    codes = pa.array(every, pa.binary()).dictionary_encode().indices.to_numpy() if every else np.zeros(0, np.int32)
    ends = np.cumsum(sizes)
    runs = runs_of(codes, np.repeat(np.arange(len(sizes)), sizes), np.repeat(ends, sizes), least)
    covered = np.zeros(len(every) + 1, np.int64)
    np.add.at(covered, runs[:, 0] + runs[:, 2], 1)
    np.add.at(covered, runs[:, 1], -1)
    repeated = np.cumsum(covered[:-1]) > 0
    own = np.searchsorted(runs[:, 0], np.r_[0, ends])
    for k, words in enumerate(texts):
        begin = int(ends[k] - sizes[k])
        mine = runs[own[k]:own[k + 1]]
        gone = repeated[begin:int(ends[k])]
        kept = [word for word, drop in zip(words, gone) if not drop] if gone.any() else words
        yield np.stack([mine[:, 0] - begin, mine[:, 1] - mine[:, 0], mine[:, 2]], axis=1), b" ".join(kept)


def _blocks(texts: list[bytes | None]) -> Iterator[list[list[bytes]]]:
    block: list[list[bytes]] = []
    size = 0
    for text in texts:
        # Bytes are split at exactly the blanks x20 and x09 to x0D.
        words = text.split() if text else []
        if block and size + len(words) > BLOCK_WORDS:
            yield block
            block, size = [], 0
        block.append(words)
        size += len(words)
    if block:
        yield block


def periodic_runs(text: Column, least: int = LEAST) -> Column:
    """struct<runs: array<start, length, period>, collapsed: string> of the words ``[^\\x20\\x09-\\x0D]+`` of ``text``.

    ``runs`` are ordered by start, then period. ``collapsed`` has the words that no run holds after its first
    period, joined by one blank.
    """

    @F.arrow_udf(f"struct<runs: array<{RUN}>, collapsed: string>")
    def find(texts: pa.Array) -> pa.Array:
        counts, rows, collapsed = [0], [], []
        for block in _blocks(texts.cast(pa.binary()).to_pylist()):
            for runs, kept in _found(block, least):
                counts.append(counts[-1] + len(runs))
                rows.append(runs)
                collapsed.append(kept)
        every = np.concatenate(rows) if rows else np.zeros((0, 3), np.int64)
        fields = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(every[:, k]), pa.int64()) for k in range(3)],
                                            names=["start", "length", "period"])
        lists = pa.ListArray.from_arrays(pa.array(counts, pa.int32()), fields)
        kept = pa.array(collapsed, pa.binary()).cast(pa.string(), safe=False)
        return pa.StructArray.from_arrays([lists, kept], names=["runs", "collapsed"])

    # Marked so that the optimizer never runs it again for each field taken from its result.
    return find.asNondeterministic()(text)


def with_runs(docs: DataFrame, runs: str = "runs", collapsed: str = "collapsed", text: str = "text",
              least: int = LEAST) -> DataFrame:
    """``docs`` with the columns ``runs`` and ``collapsed``; names already taken are replaced by the new columns."""
    found = "found"
    while found.lower() in {name.lower() for name in docs.columns}:
        found += "_"
    rows = docs.withColumn(found, periodic_runs(F.col(text), least))
    return rows.withColumns({runs: F.col(found)["runs"], collapsed: F.col(found)["collapsed"]}).drop(found)
