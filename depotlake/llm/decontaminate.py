"""Benchmark decontamination by pigeonhole edit matching.

A text that holds an item with at most ``k`` edits leaves one of any ``k + 1`` pieces of the item untouched. Items
are cut into that many pieces, one automaton finds all exact piece hits in a text, and each hit opens a window that
is verified with Myers' bit-parallel distance. Windows of one item that overlap are verified together, so frequent
pieces cost at most one pass over the text for each item.

Texts and items are compared in lower case with white space folded to one blank; ``k`` is ``BUDGET`` of the item's
length. Items go to the executors in blocks of at most ``MAX_BLOCK_CHARS`` letters, each block in a pass over all
documents, so what is broadcast has a fixed bound however large the benchmark is.

Defined results: NULL or empty texts and items match nothing. Equal items match alike, under each id. Of several
places the one with the fewest edits counts, then the leftmost. Repeated rows give repeated matches.
"""

from __future__ import annotations

from collections import defaultdict

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotlake.llm.common import fresh

BUDGET = 0.05
MAX_BLOCK_CHARS = 4_000_000
MATCHES = "array<struct<item_id:bigint,distance:int,start_at:int,end_at:int>>"


def folded(text: str) -> str:
    return " ".join(text.lower().split())


def myers(pattern: str, text: str) -> tuple[int, int]:
    """The least edit distance between ``pattern`` and any part of ``text``, and the first end that has it."""
    masks: dict[str, int] = defaultdict(int)
    for k, letter in enumerate(pattern):
        masks[letter] |= 1 << k
    size = len(pattern)
    full, top = (1 << size) - 1, 1 << (size - 1)
    plus, minus, score = full, 0, size
    best, end = size, 0
    for at, letter in enumerate(text, 1):
        equal = masks.get(letter, 0)
        vertical = equal | minus
        horizontal = (((equal & plus) + plus) ^ plus) | equal
        up = minus | (~(horizontal | plus) & full)
        down = plus & horizontal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up = up << 1 & full
        down = down << 1 & full
        plus = down | (~(vertical | up) & full)
        minus = up & vertical
        if score < best:
            best, end = score, at
    return best, end


class Finder:
    """The automaton of the pieces of one block of items."""

    def __init__(self, items: list[tuple[int, str]]):
        self.items: list[tuple[list[int], str, int]] = []
        same: dict[str, list[int]] = defaultdict(list)
        for number, text in items:
            if text:
                same[text].append(number)
        pieces: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for place, (text, numbers) in enumerate(sorted(same.items())):
            budget = int(len(text) * BUDGET)
            self.items.append((sorted(numbers), text, budget))
            bounds = [len(text) * k // (budget + 1) for k in range(budget + 2)]
            for start, end in zip(bounds, bounds[1:]):
                pieces[text[start:end]].append((place, start))
        self.automaton = ahocorasick.Automaton()
        for piece, uses in pieces.items():
            self.automaton.add_word(piece, (len(piece), uses))
        self.automaton.make_automaton()

    def find(self, text: str | None) -> list[dict]:
        text = folded(text) if text else ""
        if not text or not self.items:
            return []
        windows: dict[int, list[list[int]]] = defaultdict(list)
        for last, (size, uses) in self.automaton.iter(text):
            for place, offset in uses:
                _, item, budget = self.items[place]
                at = last + 1 - size - offset
                start, end = max(0, at - budget), min(len(text), at + len(item) + budget)
                known = windows[place]
                if known and start <= known[-1][1]:
                    known[-1][0], known[-1][1] = min(known[-1][0], start), max(known[-1][1], end)
                else:
                    known.append([start, end])
        found = []
        for place, spans in windows.items():
            numbers, item, budget = self.items[place]
            hit = self._best(item, budget, text, spans)
            if hit:
                found.extend({"item_id": number, "distance": hit[0], "start_at": hit[1], "end_at": hit[2]}
                             for number in numbers)
        return found

    @staticmethod
    def _best(item: str, budget: int, text: str, spans: list[list[int]]) -> tuple[int, int, int] | None:
        best = None
        for start, end in sorted(spans):
            exact = text.find(item, start, end)
            if exact >= 0:
                return 0, exact, exact + len(item)
            if end - start < len(item) - budget:
                continue
            distance, stop = myers(item, text[start:end])
            if distance <= budget and (best is None or distance < best[0]):
                back = text[start:start + stop][::-1]
                _, length = myers(item[::-1], back)
                best = distance, start + stop - length, start + stop
        return best


def blocks_of(items: DataFrame, item_id: str, text: str) -> list[list[tuple[int, str]]]:
    """Items with folded texts, in blocks of bounded size; one block at a time is collected when it is used."""
    chars = items.agg(F.coalesce(F.sum(F.length(text)), F.lit(0))).first()[0]
    count = -(-int(chars) // (MAX_BLOCK_CHARS // 2)) or 1
    numbered = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("text")).where(
        "item_id is not null and text is not null")
    for block in range(count):
        rows = numbered.where(F.pmod(F.xxhash64("item_id"), F.lit(count)) == block).collect()
        yield [(row["item_id"], folded(row["text"])) for row in rows]


def matched(text: Column, items: list[tuple[int, str]], spark) -> Column:
    """The matches of each text with one block of items."""
    sent = spark.sparkContext.broadcast(items)
    state: dict[str, Finder] = {}

    @F.arrow_udf(MATCHES)
    def match(texts: pa.Array) -> pa.Array:
        if "own" not in state:
            state["own"] = Finder(sent.value)
        kind = pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int32()),
                                   ("start_at", pa.int32()), ("end_at", pa.int32())]))
        return pa.array([state["own"].find(text) for text in texts.to_pylist()], kind)

    return match(text)


def contaminated(docs: DataFrame, items: DataFrame, text: str = "text", doc_id: str = "doc_id",
                 item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``doc_id, item_id, distance, start_at, end_at`` of every match; places are letters of the folded text."""
    parts = None
    for block in blocks_of(items, item_id, item_text):
        one = docs.select(F.col(doc_id).alias("doc_id"), F.explode(
            matched(F.col(text), block, docs.sparkSession)).alias("hit")).select("doc_id", "hit.*")
        parts = one if parts is None else parts.unionAll(one)
    return parts


def decontaminated(docs: DataFrame, items: DataFrame, text: str = "text",
                   item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no item; nothing is shuffled."""
    for block in blocks_of(items, item_id, item_text):
        hits = fresh(docs, "hits")
        docs = docs.withColumn(hits, matched(F.col(text), block, docs.sparkSession)).where(
            F.size(hits) == 0).drop(hits)
    return docs
