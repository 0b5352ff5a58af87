"""Near-duplicates by the exact Jaccard similarity of word shingles, from SimHash fingerprints and an index of prefixes.

Every set has a SimHash fingerprint. The index of op4 gives the pairs of fingerprints within 4 bits, and these are
candidates like any other: the whole sets decide. Most pairs at ``LEAST`` differ in more bits, so what
fingerprints leave apart meets through prefixes.

Two sets of which at least ``LEAST`` = 4/5 is shared have a shingle in common among the first n - ceil(4n/5) + 1 of
each, whatever order all sets are put in. Only these prefixes are indexed. The order is by hash, with the shingles
that are frequent in a sample last, so boilerplate makes no lists; the sample decides the cost, never the result.

Pairs of a list that their sizes and places leave open are candidates. The parities of a set's shingles, in about as
many classes as it has shingles, cannot differ in more classes than two sets differ in shingles, which rules most of them
out; what is left is decided by the whole sets. Within a list the members first meet a few pivots, which already joins a
large group of near copies; only pairs whose members are still in different components afterwards are then looked at one
by one. No pair is left out that could join two components.

Defined results: words are those of SimHash; a text of fewer than ``SHINGLE_WORDS`` words is one shingle, texts without
words are alike. A row without doc_id has no component and links nothing. Sets are known by a 64-bit hash, as are
shingles.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from depotlake.llm.common import bounded_sample, fresh, removed, settled
from depotlake.llm.components import components
from depotlake.llm.simhash import near_links, of_hashes, shingle_hashes

SHINGLE_WORDS = 5
LEAST = 4, 5
SAMPLE_DOCS = 8_000
FREQUENT = 4
WIDE = 40
MAX_FREQUENT = 200_000
PARITIES = 64
PIVOTS = 4
STAR = 64
ROUNDS = 3
PAIRS_AT_ONCE = 1
MAX_SLICES = 16
MAX_BROADCAST = 500_000
BLOCK_PAIRS = 1 << 18
PAIRS_IN_HAND = 1 << 14
# What a worker takes of a batch at once: sets of a batch of long texts take some hundred MB otherwise.
SLICE_ROWS = 512
SLICE_CHARS = 1 << 21
CANDIDATES = "kind byte, key long, a long, b long, n int, pos int"


def shingles(text: str | None) -> np.ndarray:
    """The different shingles' hashes, sorted; those of no words are the hash of nothing."""
    found = np.unique(shingle_hashes(text, SHINGLE_WORDS))
    return found if len(found) else np.zeros(1, "<u8")


def _signature(found: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(found.tobytes())).astype(np.int64))


def prefix(found: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """What has to be indexed of a sorted set, frequent shingles last."""
    size = len(found) + 1 - -(-len(found) * LEAST[0] // LEAST[1])
    if not len(frequent):
        return found[:size]
    late = frequent[np.minimum(np.searchsorted(frequent, found), len(frequent) - 1)] == found
    return np.concatenate([found[~late][:size], found[late]])[:size]


def _lists(values: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, values)], dtype=np.int32)
    flat = np.concatenate(values) if values else np.zeros(0, "<u8")
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64), pa.int64()))


def parities(found: np.ndarray) -> np.ndarray:
    """Whether a class holds an odd number of shingles, for about as many classes as there are shingles: a power of two."""
    classes = max(PARITIES, 1 << (len(found) - 1).bit_length())
    odd = np.bincount((found & np.uint64(classes - 1)).astype(np.int64), minlength=classes) & 1
    return np.packbits(odd.astype(np.uint8)).view("<u8")


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches``, a few at a time: at most ``SLICE_ROWS``, and few texts beyond ``SLICE_CHARS``."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        ends, start = np.cumsum(lengths, dtype=np.int64), 0
        while start < batch.num_rows:
            full = int(np.searchsorted(ends, ends[start] - lengths[start] + SLICE_CHARS)) + 1
            end = min(full, start + SLICE_ROWS, batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


def _described(frequent):
    """``DESCRIBED``: the prefix of each text's set, or the whole set where ``frequent`` is None."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            sets = [shingles(text) for text in batch.column("text").to_pylist()]
            lists = sets if frequent is None else [prefix(found, frequent.value) for found in sets]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([_signature(found) for found in sets], pa.int64()),
                pa.array([len(found) for found in sets], pa.int32()), _lists([parities(found) for found in sets]),
                _lists(lists), batch.column("text_hash"), pa.array([of_hashes(found) for found in sets], pa.int64())],
                ["doc_id", "sig", "n", "bits", "shingles", "text_hash", "fp"])
    return of


DESCRIBED = "doc_id long, sig long, n int, bits array<long>, shingles array<long>, text_hash long, fp long"


def _frequent(rows: DataFrame) -> np.ndarray:
    """Shingles of several sets of a sample, at most ``MAX_FREQUENT``, sorted.

    The sample grows with the rows, so that shingles of more than some ``WIDE`` sets are told whatever their number;
    else the lists of the index grew with the rows, and their pairs with the square.
    """
    sample = bounded_sample(rows, ["doc_id"], max(SAMPLE_DOCS, rows.count() * FREQUENT // WIDE))
    sets = sample.mapInArrow(_described(None), DESCRIBED).dropDuplicates(["sig"])
    counted = sets.select(F.explode("shingles").alias("key")).groupBy("key").count().where(F.col("count") >= FREQUENT)
    found = counted.orderBy(F.desc("count"), "key").limit(MAX_FREQUENT).select("key").toPandas()["key"]
    return np.sort(found.to_numpy(np.int64).view(np.uint64))


def _open(n: np.ndarray, pos: np.ndarray, other_n, other_pos) -> np.ndarray:
    """Whether pairs that meet at these places of their prefixes can be similar enough, by what is left of each."""
    parts, of = LEAST
    shared = np.minimum(np.minimum(pos, other_pos) + np.minimum(n - pos, other_n - other_pos), np.minimum(n, other_n))
    return shared * (parts + of) >= parts * (n + other_n)


def _first_open(n: np.ndarray, pos: np.ndarray, other_n, other_pos) -> np.ndarray:
    """Whether pairs whose first shingle in common is at these places can be similar enough: nothing before it is shared.

    Similar pairs pass at the first shingle they have in common, and that is all they need.
    """
    parts, of = LEAST
    return np.minimum(n - pos, other_n - other_pos) * (parts + of) >= parts * (n + other_n)


def _whole_lists(frames: Iterator[pd.DataFrame], columns: list[str]) -> Iterator[tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]]:
    """Columns of rows sorted by key, and where their lists of two members and more start and end.

    A list is never cut: what may go on in the next batch waits for it.
    """
    rest = None

    def cut(held: dict[str, np.ndarray]):
        key = held["key"]
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, int)
        ends = np.r_[starts[1:], len(key)].astype(int)
        several = ends - starts > 1
        return held, starts[several], ends[several]

    for frame in frames:
        if not len(frame):
            continue
        held = {c: frame[c].to_numpy() for c in columns if c in frame}
        if rest is not None:
            held = {c: np.concatenate((rest[c], held[c])) for c in held}
        last = int(np.searchsorted(held["key"], held["key"][-1]))
        yield cut({c: values[:last] for c, values in held.items()})
        rest = {c: values[last:] for c, values in held.items()}
    if rest is not None:
        yield cut(rest)


def _fitting(n: np.ndarray, other_n: np.ndarray) -> np.ndarray:
    """Whether sets of these sizes can be similar enough."""
    return np.maximum(n, other_n) <= np.minimum(n, other_n) * LEAST[1] // LEAST[0]


def _pairs_frame(parts: list[tuple[np.ndarray, np.ndarray]]) -> pd.DataFrame:
    a, b = (np.concatenate(side) for side in zip(*parts))
    return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})


def _with_pivots(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Open pairs: the two members of a list of two, and each member of a longer one with a pivot of like size.

    Longer lists also come out as they were: what they hold besides is left to ``_across``, which leaves out no pair
    that could join two components.
    """
    for held, starts, ends in _whole_lists(frames, ["key", "sig", "n", "pos"]):
        if not len(starts):
            continue
        key, sig, n, pos = held["key"], held["sig"], held["n"].astype(np.int64), held["pos"].astype(np.int64)
        one = starts[ends - starts == 2]
        near = one[_fitting(n[one], n[one + 1]) & _first_open(n[one], pos[one], n[one + 1], pos[one + 1])]
        parts = [(sig[near], sig[near + 1])] if len(near) else []
        longer = np.zeros(len(key), bool)
        for start, end in zip(starts[ends - starts > 2].tolist(), ends[ends - starts > 2].tolist()):
            longer[start:end] = True
            parts += _pairs_with_pivots(int(key[start]), sig[start:end], n[start:end], pos[start:end])
        if parts:
            yield _pairs_frame(parts).assign(kind=np.int8(0), key=np.int64(0), n=np.int32(0), pos=np.int32(0))[
                ["kind", "key", "a", "b", "n", "pos"]]
        if longer.any():
            yield pd.DataFrame({"kind": np.int8(1), "key": key[longer], "a": sig[longer], "b": np.int64(0),
                                "n": held["n"][longer], "pos": held["pos"][longer]})


def _pairs_with_pivots(key: int, sig: np.ndarray, n: np.ndarray, pos: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    order = np.lexsort((sig, n))
    sig, n, pos = sig[order], n[order], pos[order]
    # The same pivot for all lists of a group, or one of a few, so that its pairs repeat.
    rank = sig.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15 + 2 * (key % PIVOTS))
    start, found = 0, []
    while start < len(sig):
        end = int(np.searchsorted(n, n[start] * LEAST[1] // LEAST[0], "right"))
        pivot = start + int(np.argmin(rank[start:end]))
        near = start + np.flatnonzero(_open(n[start:end], pos[start:end], n[pivot], pos[pivot]))
        near = near[near != pivot]
        if len(near):
            found.append((np.full(len(near), sig[pivot]), sig[near]))
        start = end
    return found


def _across(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The pairs of a list whose members are in different components, but for those that sizes, places or, where there are
    ``bits``, parities rule out."""
    parts, held_pairs = [], 0
    for held, starts, ends in _whole_lists(frames, ["key", "sig", "n", "pos", "root", "bits"]):
        for start, end in zip(starts.tolist(), ends.tolist()):
            if (held["root"][start:end] == held["root"][start]).all():
                continue
            order = start + np.argsort(held["n"][start:end], kind="stable")
            for a, b in _pairs_across({c: values[order] for c, values in held.items()}):
                parts.append((a, b))
                held_pairs += len(a)
                if held_pairs > BLOCK_PAIRS:
                    yield _pairs_frame(parts).drop_duplicates()
                    parts, held_pairs = [], 0
    if parts:
        yield _pairs_frame(parts).drop_duplicates()


def _pairs_across(members: dict[str, np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of one list in ascending order of size, some ``PAIRS_IN_HAND`` looked at together."""
    sig, root, n, pos = members["sig"], members["root"], members["n"].astype(np.int64), members["pos"].astype(np.int64)
    counts = np.searchsorted(n, n * LEAST[1] // LEAST[0], "right") - np.arange(len(n)) - 1
    ends, start = np.cumsum(counts), 0
    differ = _differing(members["bits"]) if "bits" in members else None
    while start < len(n):
        before = ends[start] - counts[start]
        stop = max(start + 1, int(np.searchsorted(ends, before + PAIRS_IN_HAND, "right")))
        one = np.repeat(np.arange(start, stop), counts[start:stop])
        two = one + 1 + np.arange(len(one)) - np.repeat(ends[start:stop] - counts[start:stop] - before, counts[start:stop])
        near = (root[one] != root[two]) & _first_open(n[one], pos[one], n[two], pos[two])
        one, two = one[near], two[near]
        if differ is not None and len(one):
            near = differ(one, two) * sum(LEAST) <= (n[one] + n[two]) * (LEAST[1] - LEAST[0])
            one, two = one[near], two[near]
        if len(one):
            yield sig[one], sig[two]
        start = stop


def _differing(bits: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """The number of classes of unlike parity of pairs of ``bits``, the second with as many classes or twice as many."""
    lengths = np.array([len(x) for x in bits])
    place, held = np.zeros(len(bits), int), {}
    for length in np.unique(lengths).tolist():
        of = np.flatnonzero(lengths == length)
        place[of], held[length] = np.arange(len(of)), np.stack(bits[of])

    def between(one: np.ndarray, two: np.ndarray) -> np.ndarray:
        out = np.zeros(len(one), np.int64)
        for length, of in held.items():
            for times in (1, 2):
                at = np.flatnonzero((lengths[one] == length) & (lengths[two] == times * length))
                if len(at):
                    other = held[times * length][place[two[at]]]
                    other = other if times == 1 else other[:, :length] ^ other[:, length:]
                    out[at] = np.bitwise_count((of[place[one[at]]] ^ other).view(np.uint64)).sum(axis=1)
        return out

    return between


def _by_fingerprint(prints: DataFrame) -> DataFrame:
    """Pairs ``a, b`` of sets that connect all whose fingerprints are equal or within the bits of SimHash."""
    reps = settled(prints.groupBy("fp").agg(F.min("sig").alias("rep")), "fingerprints")
    equal = prints.select("fp", "sig").join(reps, "fp").where("sig > rep").select(F.col("rep").alias("a"), F.col("sig").alias("b"))
    found = settled(near_links(reps).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).union(equal),
                    "fingerprint_pairs")
    removed(reps)
    return found


def _folded(bits: str, length: Column) -> Column:
    """Parities of ``length`` words, from as many or twice as many."""
    halves = F.slice(bits, F.lit(1), length), F.slice(bits, length + 1, length)
    return F.when(F.size(bits) > length, F.zip_with(*halves, lambda x, y: x.bitwiseXOR(y))).otherwise(F.col(bits))


def _possible(pairs: DataFrame, prints: DataFrame) -> DataFrame:
    """The pairs that neither sizes nor parities rule out.

    Sets that fit have as many classes or twice as many; half as many come of the two halves' difference.
    """
    parts, of = LEAST
    one, two = (prints.select(F.col("sig").alias(c), F.col("n").alias(f"n_{c}"), F.col("bits").alias(f"bits_{c}"))
                for c in "ab")
    length = F.least(F.size("bits_a"), F.size("bits_b"))
    differ = F.aggregate(F.zip_with(_folded("bits_a", length), _folded("bits_b", length), lambda x, y: F.bit_count(x.bitwiseXOR(y))),
                         F.lit(0), lambda x, y: x + y)
    fitting = F.greatest("n_a", "n_b") * parts <= F.least("n_a", "n_b") * of
    similar = differ * (of + parts) <= (F.col("n_a") + F.col("n_b")) * (of - parts)
    return pairs.join(one, "a").join(two, "b").where(F.when(fitting, similar).otherwise(False)).select("a", "b")


def _stars(pairs: DataFrame) -> DataFrame:
    """Each pair as ``center, member, rank``: the set with more pairs is the centre, and its rank for the member."""
    both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    degree = both.groupBy("a").agg(F.count("*").alias("degree"))
    one, two = (degree.select(F.col("a").alias(c), F.struct("degree", "a").alias(f"rank_{c}")) for c in "ab")
    ranked = pairs.join(one, "a").join(two, "b")
    first = F.col("rank_a") > F.col("rank_b")
    return ranked.select(F.when(first, F.col("a")).otherwise(F.col("b")).alias("center"),
                         F.when(first, F.col("b")).otherwise(F.col("a")).alias("member"),
                         F.greatest("rank_a", "rank_b").alias("rank"))


def _similar(stars: DataFrame, prints: DataFrame, rows: DataFrame, repeated: bool) -> DataFrame:
    """The pairs ``a, b`` of ``stars`` of which enough is shared, by their whole sets.

    Sets are made again from the texts they stand for; only where rows are ``repeated``, id and set, are they sorted and
    shuffled to keep one of each. A set goes once to each centre it is paired with, and a centre
    once to every ``STAR`` of its members, so a centre with very many members is spread over tasks.
    """
    parts, of = LEAST
    sizes = stars.groupBy("center").agg(F.ceil(F.count("*") / STAR).alias("blocks"))
    placed = settled(stars.join(sizes, "center").select(
        "center", "member", F.pmod(F.xxhash64("member"), F.col("blocks")).alias("block")), "stars")
    nodes = placed.select(F.col("center").alias("sig")).union(placed.select("member")).distinct()
    wanted = settled(prints.join(nodes, "sig").select("sig", F.col("rep").alias("doc_id")), "wanted")
    # A few ids are sent to the texts; else the texts go to the ids.
    sent = F.broadcast(wanted) if wanted.count() <= MAX_BROADCAST else wanted
    made = rows.join(sent.select("doc_id"), "doc_id", "left_semi").mapInArrow(_described(None), DESCRIBED)
    made = made.select("sig", "doc_id", "shingles").join(sent, ["sig", "doc_id"], "left_semi").select("sig", "shingles")
    sets = settled(made.dropDuplicates(["sig"]) if repeated else made, "sets")
    few = placed.count() <= MAX_BROADCAST
    members, centers = placed, placed.select("center", "block").distinct()
    if few:
        members, centers = F.broadcast(members), F.broadcast(centers)
    whole = sets.join(members, F.col("sig") == F.col("member")).select(
        "center", "block", "member", F.col("shingles").alias("own"))
    middle = sets.join(centers, F.col("sig") == F.col("center")).select("center", "block", F.col("shingles").alias("other"))
    shared, both = F.size(F.array_intersect("own", "other")), F.size("own") + F.size("other")
    found = settled(whole.hint("merge").join(middle, ["center", "block"]).where(
        shared * (of + parts) >= both * parts).select(F.least("center", "member").alias("a"), F.greatest("center", "member").alias("b")),
        "similar")
    removed(placed, wanted, sets)
    return found


def _connecting(pairs: DataFrame, known: DataFrame | None, prints: DataFrame, rows: DataFrame,
                repeated: bool) -> tuple[DataFrame, DataFrame]:
    """``known`` links, and of ``pairs`` similar ones until they connect all that similar pairs connect; and the
    components of these links.

    Where there are no more pairs than sets, all are compared at once. Otherwise every set first meets the one of its
    partners that has most; what these links join need not be compared any more. After ``ROUNDS`` such rounds, or as soon
    as few pairs are left, all that are left are compared, so none is left out.
    """
    left, links, sets = settled(_possible(pairs, prints), "possible"), known, prints.count()
    for turn in range(ROUNDS + 1):
        last = turn == ROUNDS or left.count() <= sets * PAIRS_AT_ONCE
        stars = settled(_stars(left), "pairs")
        if not last:
            chosen = stars.groupBy("member").agg(F.max(F.struct("rank", "center")).alias("best")).select(
                F.col("best")["center"].alias("center"), "member")
        else:
            chosen = stars.select("center", "member")
        # As many parts as there are pairs for each set, so that a part sends no more than about every set once.
        slices = min(MAX_SLICES, -(-chosen.count() // max(1, sets)))
        for part in range(max(1, slices)):
            mine = chosen.where(F.pmod(F.xxhash64("center"), F.lit(slices)) == part) if slices > 1 else chosen
            found = _similar(mine, prints, rows, repeated)
            links = found if links is None else links.union(found)
        member = settled(components(links), "joined")
        if last:
            break
        one, two = (member.select(F.col("node").alias(c), F.col("component").alias(f"of_{c}")) for c in "ab")
        done = chosen.select(F.least("center", "member").alias("a"), F.greatest("center", "member").alias("b"))
        rest = settled(left.join(done, ["a", "b"], "left_anti").join(one, "a", "left").join(two, "b", "left").where(
            F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).select("a", "b"), "possible")
        removed(left, stars)
        left = rest
        removed(member)
    out = settled(links.distinct(), "links")
    removed(left, stars)
    return out, member


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, component_id, text_hash, root`` for every row.

    ``component_id`` is the least doc_id that links reach. ``root`` names the component of the text, as rows of one
    doc_id may have unlike texts, which ``text_hash`` tells apart.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_hash"))
    frequent = docs.sparkSession.sparkContext.broadcast(_frequent(rows))
    described = settled(rows.mapInArrow(_described(frequent), DESCRIBED), "prefixes")
    known = described.where("doc_id is not null")
    prints = settled(known.groupBy("sig").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("bits").alias("bits"),
                                                F.first("fp").alias("fp")), "prints")
    repeated = not known.groupBy("doc_id", "sig").count().where("count > 1").isEmpty()
    alike = _by_fingerprint(prints)
    postings = known.dropDuplicates(["sig"]).select("sig", "n", F.posexplode("shingles").alias("pos", "key")).select("key", "sig", "n", "pos")
    found = settled(postings.repartition(F.col("key")).sortWithinPartitions("key").mapInPandas(
        _with_pivots, CANDIDATES), "candidates")
    ids = settled(described.select("doc_id", "sig", "text_hash"), "ids")
    removed(described)
    first = settled(found.where("kind = 0").select("a", "b").union(alike).distinct(), "first_pairs")
    links, roots = _connecting(first, None, prints, rows, repeated)
    lists = found.where("kind = 1").select("key", F.col("a").alias("sig"), "n", "pos")
    # Half the classes tell unlike sets apart, so that most of their pairs are not even put forward.
    half = F.greatest(F.lit(1), F.floor(F.size("bits") / 2).cast("int"))
    bits = prints.select("sig", _folded("bits", half).alias("bits"))
    lists = lists.join(roots, F.col("sig") == F.col("node"), "left").join(bits, "sig").select(
        "key", "sig", "n", "pos", F.coalesce("component", "sig").alias("root"), "bits")
    # As many tasks as there are reducers: their work is that of pairs, which the size of the rows does not tell.
    reducers = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    second = lists.repartition(reducers, F.col("key")).sortWithinPartitions("key").mapInPandas(_across, "a long, b long")
    second = settled(second.distinct().join(first, ["a", "b"], "left_anti"), "second_pairs")
    removed(found, alike, first, roots)
    _, member = _connecting(second, links, prints, rows, repeated)
    removed(second, links)
    rooted = prints.join(member, F.col("sig") == F.col("node"), "left").select(
        "sig", "rep", F.coalesce("component", "sig").alias("root"))
    least = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    of = rooted.join(least, "root").select("sig", "component_id", "root")
    has_id = F.col("doc_id").isNotNull()
    return ids.join(of, "sig", "left").select(
        "doc_id", F.when(has_id, F.col("component_id")).alias("component_id"), "text_hash",
        F.when(has_id, F.col("root")).alias("root"))


def one_of_each_group(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """All columns of one row for each group of near-duplicates; rows without doc_id stay.

    The row with the least doc_id stays; of rows of that id with unlike texts in one group one, by hash; rows of one id
    in different groups stand for their own group each. Of repeated rows the one whose hash is least stays. Texts are
    shuffled once, by id and hash.
    """
    groups = near_duplicates(docs, text, doc_id).where("doc_id is not null")
    kept = groups.groupBy("root").agg(F.min(F.struct("doc_id", "text_hash")).alias("kept")).select(
        F.col("kept")["doc_id"].alias("kept_id"), F.col("kept")["text_hash"].alias("kept_text")).distinct()
    key, own, rank = fresh(docs, "kept_id"), fresh(docs, "kept_text"), fresh(docs, "rank")
    rows = docs.join(kept.toDF(key, own), (F.col(doc_id) == F.col(key)) & (F.xxhash64(text) == F.col(own)), "left_semi")
    first = Window.partitionBy(doc_id, F.xxhash64(text)).orderBy(F.xxhash64(*docs.columns))
    chosen = rows.withColumn(rank, F.row_number().over(first)).where(F.col(rank) == 1).drop(rank)
    return chosen.union(docs.where(F.col(doc_id).isNull()))
