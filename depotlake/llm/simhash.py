"""SimHash near-duplicates from a byte-position inverted index with count filtering.

A fingerprint has 64 bits, eight positional bytes. Two fingerprints that differ in at most ``MAX_BITS`` = 4 bits
differ in at most four bytes, so they share at least ``MIN_SHARED`` = 4 positional bytes. A pair reaches that tally
exactly if some choice of four positions holds equal bytes in both; the index is therefore kept under the 70
choices of four (position, byte) entries, each a 32-bit key, instead of single entries: a posting list then
holds only pairs that already passed the count filter, and lists of one are dropped before any pair is looked at.
The tally and the number of differing bits are then taken for each pair of a list.

Lists are made from distinct fingerprints. Within a list links are found by breadth-first search, which drops a
fingerprint once it is reached, so a large group of near copies gives about one link per member instead of all
pairs. A list beyond ``LARGE_LIST`` members is not searched in one task: each member puts forward all values
within two bits of its free bytes, and members that meet at a value are linked to the least of them, which is
exact, because two values within four bits have a value within two bits of both.

Defined results: no words (NULL, empty or white text) give fingerprint zero, linked like any other. A row without
doc_id gets a fingerprint and no component, and links nothing. Repeated rows share their component.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from depotlake.llm.common import fresh, settled
from depotlake.llm.components import components

SHINGLE_WORDS = 4
MAX_BITS = 4
MIN_SHARED = 8 - MAX_BITS
SEED = 42
LARGE_LIST = 1 << 16
CHOICES = list(itertools.combinations(range(8), MIN_SHARED))


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """The hash of every ``size`` words in a row; a shorter text is one shingle, a text without words has none."""
    words = text.encode("utf-8", "replace").lower().split() if text else []
    if not words:
        return np.zeros(0, "<u8")
    joined = b" ".join(words)
    ends = list(itertools.accumulate(len(word) + 1 for word in words))
    starts = [0, *ends[:-1]]
    digest = xxhash.xxh64_intdigest
    spans = zip(starts, ends[size - 1:]) if len(words) > size else [(0, len(joined) + 1)]
    return np.array([digest(joined[a:b - 1], SEED) for a, b in spans], "<u8")


def simhash(text: str | None, size: int = SHINGLE_WORDS) -> int:
    """The signed 64-bit fingerprint; a bit is set if more than half of the shingles' hashes have it."""
    return of_hashes(shingle_hashes(text, size))


def of_hashes(hashes: np.ndarray) -> int:
    """The signed fingerprint of shingles given by their hashes; zero for none."""
    if not len(hashes):
        return 0
    counts = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 15):
        part = hashes[k:k + (1 << 15)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprint(text: Column) -> Column:
    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([simhash(text) for text in texts.to_pylist()], pa.int64())

    return of(text)


def as_hex(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def _postings(prints: DataFrame) -> DataFrame:
    """``(choice, key, fp, rep)``: each fingerprint under every choice of four positional bytes."""
    position = [F.shiftrightunsigned("fp", 8 * k).bitwiseAND(F.lit(255)) for k in range(8)]
    keys = []
    for number, choice in enumerate(CHOICES):
        key = F.lit(number).cast("long")
        for k in choice:
            key = F.shiftleft(key, 8).bitwiseOR(position[k])
        keys.append(key)
    return prints.select("fp", "rep", F.explode(F.array(*keys)).alias("key"))


def _near(differing: np.ndarray) -> np.ndarray:
    """Of pairs that met, given as the XOR of both: those whose tally of equal positional bytes reaches the guaranteed
    minimum and that then verify."""
    tally = (differing.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
    near = tally >= MIN_SHARED
    near[near] = np.bitwise_count(differing[near]) <= MAX_BITS
    return near


def _search(values: np.ndarray, reps: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect whatever is connected within one posting list."""
    links, left = [], np.arange(len(values))
    while len(left):
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            at = frontier.pop()
            near = _near(values[left] ^ values[at])
            if near.any():
                reached = left[near]
                links.extend((int(reps[at]), int(reps[other])) for other in reached)
                frontier.extend(reached)
                left = left[~near]
    return links


def _around(key: int, values: np.ndarray, reps: np.ndarray) -> Iterator[pd.DataFrame]:
    """All values within two bits of the free bytes of each member of a large list."""
    fixed = CHOICES[key >> 32]
    free = [8 * k + bit for k in range(8) if k not in fixed for bit in range(8)]
    one = [1 << bit for bit in free]
    masks = np.array([0, *one, *(a | b for a, b in itertools.combinations(one, 2))], np.uint64)
    for k in range(0, len(values), 1 << 10):
        near = values[k:k + (1 << 10), None] ^ masks[None, :]
        yield pd.DataFrame({"kind": np.int8(1), "key": key, "a": near.ravel().view(np.int64),
                            "b": np.repeat(reps[k:k + (1 << 10)], len(masks))})


def _links_of_lists(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by key; one list at a time, which may go over several batches."""
    def lists():
        rest = None
        for frame in frames:
            key = frame["key"].to_numpy()
            fp, rep = frame["fp"].to_numpy().view(np.uint64), frame["rep"].to_numpy()
            if rest is not None:
                key, fp, rep = (np.concatenate(x) for x in zip(rest, (key, fp, rep)))
            if not len(key):
                continue
            last = int(np.searchsorted(key, key[-1]))
            yield key[:last], fp[:last], rep[:last]
            rest = key[last:], fp[last:], rep[last:]
        if rest is not None:
            yield rest

    for keys, fps, reps in lists():
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.array([], int)
        sizes = np.diff(np.r_[starts, len(keys)])
        links: list[tuple[int, int]] = []
        pairs = starts[sizes == 2]
        near = pairs[_near(fps[pairs] ^ fps[pairs + 1])]
        links.extend(zip(reps[near].tolist(), reps[near + 1].tolist()))
        for start, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
            members, of = fps[start:start + size], reps[start:start + size]
            if size > LARGE_LIST:
                yield from _around(int(keys[start]), members, of)
            else:
                links.extend(_search(members, of))
        if links:
            a, b = np.array(links, np.int64).T
            yield pd.DataFrame({"kind": np.int8(0), "key": np.int64(0), "a": a, "b": b})


def near_links(prints: DataFrame) -> DataFrame:
    """Links ``(a, b)`` between representatives; ``prints`` has each fingerprint ``fp`` once, with ``rep``."""
    lists = _postings(prints).repartition(F.col("key")).sortWithinPartitions("key")
    found = settled(lists.mapInPandas(_links_of_lists, "kind byte, key long, a long, b long"), "pairs")
    met = found.where("kind = 1").groupBy("key", "a").agg(F.min("b").alias("least"))
    star = found.where("kind = 1").join(met, ["key", "a"]).where("b > least").select(
        F.col("b").alias("a"), F.col("least").alias("b"))
    return found.where("kind = 0").select("a", "b").union(star).distinct()


def with_components(docs: DataFrame, doc_id: str, fp: str, component: str) -> DataFrame:
    """``docs`` with the component of its fingerprint column: the least doc_id that links reach."""
    prints = settled(docs.groupBy(F.col(fp).alias("fp")).agg(F.min(doc_id).alias("rep")).where(
        "rep is not null"), "prints")
    member = components(near_links(prints))
    roots = prints.join(member, F.col("rep") == F.col("node"), "left").select(
        F.col("fp").alias(fp), F.coalesce("component", "rep").alias(component))
    return docs.join(roots, fp, "left").withColumn(
        component, F.when(F.col(doc_id).isNotNull(), F.col(component)))


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row; texts are read once and never shuffled."""
    ids = settled(docs.select(F.col(doc_id).cast("long").alias("doc_id"), fingerprint(F.col(text)).alias("fp")), "fingerprints")
    return with_components(ids, "doc_id", "fp", "component_id").select(
        "doc_id", as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def one_of_each_group(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                      groups: Callable[[DataFrame, str, str], DataFrame] = near_duplicates) -> DataFrame:
    """All columns of one row for each component of ``groups``: the one with the least doc_id; rows without id stay.

    Of repeated rows of that id the one whose hash is least stays. The join and the choice both go by doc_id, so
    texts are shuffled once.
    """
    kept = groups(docs, text, doc_id).where("doc_id = component_id").select("doc_id").distinct()
    key, rank = fresh(docs, "kept_id"), fresh(docs, "rank")
    rows = docs.join(kept.withColumnRenamed("doc_id", key), F.col(doc_id) == F.col(key), "left_semi")
    first = Window.partitionBy(doc_id).orderBy(F.xxhash64(*docs.columns))
    chosen = rows.withColumn(rank, F.row_number().over(first)).where(F.col(rank) == 1).drop(rank)
    return chosen.union(docs.where(F.col(doc_id).isNull()))
