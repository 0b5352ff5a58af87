"""Operators on groups of rows: SimHash, components, recurring passages, top-k; and the pipeline."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from depotlake.llm import components as components_module
from depotlake.llm import jaccard, queries, simhash, substrings, topk
from depotlake.llm.components import SALTS, _with_least, components

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def docs_of(spark, rows):
    return spark.createDataFrame([(k, text, "en", "s", 0) for k, text in rows], DOCS)


def union_find(nodes, links):
    parent = {node: node for node in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {node: root(node) for node in nodes}


# --- SimHash -------------------------------------------------------------------------------------------------

def fingerprint_by_force(text):
    words = WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[k:k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def near_texts():
    rng = random.Random(1)
    words = [f"{c}{k}" for c in "aÉb" for k in range(40)]
    out = [None, "", " \n", "One two three", "one TWO\x0bthree", "x\x85y"]
    for _ in range(25):
        base = [rng.choice(words) for _ in range(rng.randrange(3, 120))]
        out.append(" ".join(base))
        for _ in range(rng.randrange(4)):
            copy = list(base)
            copy[rng.randrange(len(copy))] = rng.choice(words)
            out.append("\t".join(copy))
    return out


def test_near_duplicates_agree_with_all_pairs(spark):
    rows = list(enumerate(near_texts(), 5))
    prints = {k: fingerprint_by_force(text) for k, text in rows}
    links = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 4]
    wanted = union_find(prints, links)
    got = simhash.near_duplicates(docs_of(spark, rows)).collect()
    assert {r["doc_id"]: (int(r["fingerprint"], 16), r["component_id"]) for r in got} == {
        k: (prints[k], wanted[k]) for k in prints}
    assert all(re.fullmatch("[0-9a-f]{16}", r["fingerprint"]) for r in got)


def random_prints(count, seed, flips=4):
    rng = random.Random(seed)
    base = [rng.getrandbits(64) for _ in range(count)]
    out = set(base)
    for value in base:
        for _ in range(rng.randrange(6)):
            out.add(value ^ sum({1 << rng.randrange(64) for _ in range(rng.randrange(1, flips + 2))}))
    return sorted(out)


@pytest.mark.parametrize("large", [1 << 16, 3])
def test_links_reach_every_pair_within_four_bits(large, monkeypatch):
    """Also where lists are so large that members meet at values around them."""
    monkeypatch.setattr(simhash, "LARGE_LIST", large)
    values = random_prints(60, 2)
    rows = []
    for number, choice in enumerate(simhash.CHOICES):
        for rep, value in enumerate(values):
            key = number
            for k in choice:
                key = key << 8 | value >> 8 * k & 255
            rows.append((key, np.uint64(value).astype(np.int64), rep))
    frame = pd.DataFrame(sorted(rows), columns=["key", "fp", "rep"])
    pieces = [frame[k:k + 50] for k in range(0, len(frame), 50)]
    found = pd.concat(simhash._links_of_lists(iter(pieces)))
    links = list(found[found.kind == 0][["a", "b"]].itertuples(index=False, name=None))
    for _, group in found[found.kind == 1].groupby(["key", "a"]):
        links += [(group.b.min(), other) for other in group.b if other != group.b.min()]
    assert all((values[a] ^ values[b]).bit_count() <= 4 for a, b in links)
    true = [(a, b) for a in range(len(values)) for b in range(a) if (values[a] ^ values[b]).bit_count() <= 4]
    assert true and union_find(range(len(values)), links) == union_find(range(len(values)), true)


def test_one_group_of_many_copies(spark):
    rows = [(k, "the same few words here") for k in range(300)] + [(300, "another text altogether, and longer")]
    got = simhash.near_duplicates(docs_of(spark, rows)).groupBy("component_id").count().collect()
    assert {(r["component_id"], r["count"]) for r in got} == {(0, 300), (300, 1)}


def test_rows_without_id_repeated_rows_and_empty_tables(spark):
    rows = docs_of(spark, [(None, "a b c d"), (3, "a b c d"), (3, "a b c d"), (None, "q")])
    got = simhash.near_duplicates(rows).collect()
    assert Counter((r["doc_id"], r["component_id"]) for r in got) == {(None, None): 2, (3, 3): 2}
    assert simhash.near_duplicates(rows.where("false")).count() == 0
    clashing = rows.withColumns({"fp": F.lit(1), "kept_id": F.lit(2), "rank": F.lit(3), "component_id": F.lit(4)})
    kept = simhash.one_of_each_group(clashing)
    assert kept.columns == clashing.columns
    assert sorted((r["doc_id"] or -1, r["text"]) for r in kept.collect()) == [(-1, "a b c d"), (-1, "q"), (3, "a b c d")]


def test_components_of_paths_stars_and_nothing(spark):
    rng = random.Random(4)
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)]
    links += [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)]
    links = [(a, b) for a, b in links if a != b]
    rng.shuffle(links)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == union_find({x for link in links for x in link}, links)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_links_of_one_node_are_dealt_over_tasks(spark):
    """A star of 6,000 links, in either direction: no task of the join gets more than a few shares of it."""
    star = spark.range(1, 6001).select(F.lit(0).cast("long").alias("a"), F.col("id").alias("b"))
    for links in (star, star.select(F.col("b").alias("a"), (-F.col("a")).alias("b"))):
        assert {(r["a"], r["least"]) for r in _with_least(links).groupBy("a").agg(F.min("least").alias("least")).collect()} == {
            (r["a"], r["b"]) for r in links.groupBy("a").agg(F.min("b").alias("b")).collect()}
    shares = star.groupBy(F.pmod(F.xxhash64("b"), F.lit(SALTS))).count().agg(F.max("count")).first()[0]
    assert shares < 200
    got = components(star)
    assert got.count() == 6001 and got.where("component <> 0").isEmpty()


def test_pairs_are_tallied_then_verified():
    """Four bits in four bytes pass; four bytes of more bits pass the tally only; four bits of few bytes pass both."""
    differing = np.array([0, 0x01010101, 0x03010101, 0xF, 0x0101010101], np.uint64)
    assert simhash._near(differing).tolist() == [True, True, False, True, False]
    assert simhash._near(differing[:0]).tolist() == []


# --- Jaccard -------------------------------------------------------------------------------------------------

def sets_by_force(rows):
    words = [(k, WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))) for k, text in rows]
    return {k: {tuple(w[at:at + 5]) for at in range(max(1, len(w) - 4))} for k, w in words}


def edited_texts():
    """Groups of copies with one to three edits each, many around the limit, behind one common opening."""
    rng = random.Random(8)
    words, opening = [f"w{k}" for k in range(400)], " ".join(f"open{k}" for k in range(15))
    out = [None, "", " \n", "One two three", "one TWO\x0bthree"]
    for group in range(14):
        base = [rng.choice(words) for _ in range(rng.randrange(30, 120))]
        for _ in range(40 if group == 0 else 6):
            copy = list(base)
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            out.append(opening + " " + " ".join(copy))
    return out


@pytest.mark.parametrize("frequent", [4, 1 << 30])
def test_jaccard_groups_agree_with_all_pairs(spark, frequent, monkeypatch):
    """Whether or not a sample tells the frequent shingles."""
    monkeypatch.setattr(jaccard, "FREQUENT", frequent)
    rows = list(enumerate(edited_texts(), 5))
    sets = sets_by_force(rows)
    links = [(a, b) for a in sets for b in sets if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    assert any(5 * len(sets[a] & sets[b]) < 4.2 * len(sets[a] | sets[b]) for a, b in links)
    got = jaccard.near_duplicates(docs_of(spark, rows + [(None, rows[9][1]), rows[9]])).collect()
    assert Counter((r["doc_id"], r["component_id"]) for r in got) == Counter(
        [*union_find(sets, links).items(), (None, None), (rows[9][0], union_find(sets, links)[rows[9][0]])])


def test_sets_are_made_of_a_few_texts_at_a_time(monkeypatch):
    """A worker holds the sets of a slice of its batch, and rows keep their order, NULL and long texts too."""
    monkeypatch.setattr(jaccard, "SLICE_ROWS", 4)
    monkeypatch.setattr(jaccard, "SLICE_CHARS", 40)
    texts = [None, "a b", "x " * 60, "", *(f"w{k}" for k in range(12)), "y " * 60, "z " * 60]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string()),
                                        pa.array([0] * len(texts))], ["doc_id", "text", "text_hash"])
    made = list(jaccard._described(None)(iter([batch, batch[:0]])))
    assert max(part.num_rows for part in made) == 4 and len(made) > 5
    table = pa.Table.from_batches(made)
    assert table["doc_id"].to_pylist() == list(range(len(texts)))
    assert table["shingles"].to_pylist() == [jaccard.shingles(text).view(np.int64).tolist() for text in texts]


def test_sets_are_shuffled_to_one_only_where_rows_repeat(spark, monkeypatch):
    asked, similar = [], jaccard._similar
    monkeypatch.setattr(jaccard, "_similar", lambda *args: asked.append(args[-1]) or similar(*args))
    base = [f"w{k}" for k in range(60)]
    rows = [(1, " ".join(base)), (2, " ".join([*base, "end"])), (3, "of its own")]
    for more in ([], [rows[0]] * 2):
        got = jaccard.near_duplicates(docs_of(spark, rows + more)).collect()
        assert {r["doc_id"]: r["component_id"] for r in got} == {1: 1, 2: 1, 3: 3} and len(got) == 3 + len(more)
        assert set(asked) == {bool(more)}
        asked.clear()


def test_pairs_that_pivots_leave_apart_are_still_met():
    """Every open pair of unlike components is put forward, by lists over several batches too."""
    rows = pd.DataFrame({"key": [1] * 6 + [2] * 3, "sig": [*range(6), 0, 1, 2], "n": 50, "pos": 0, "root": [0, 0, 2, 3, 4, 5, 0, 0, 0]})
    found = pd.concat(jaccard._across(iter([rows[:2], rows[2:7], rows[7:]])))
    assert set(found.itertuples(index=False, name=None)) == {(a, b) for b in range(6) for a in range(b)} - {(0, 1)}


@pytest.mark.parametrize("with_bits", [False, True])
def test_pivots_and_pairs_across_leave_out_no_similar_pair(with_bits):
    """Lists of any length, cut by batches anywhere: what ``_with_pivots`` puts forward and what ``_across`` adds, with each
    set a component of its own, holds every similar pair of random sets, by plain arithmetic; and not all pairs."""
    rng = np.random.default_rng(3)
    common = rng.integers(0, 1 << 63, 12, dtype=np.uint64)
    sets = []
    for size in (5, 9, 30, 63, 64, 70, 200, 1030):
        for copies in (1, 2, 3, 12):
            base = rng.integers(0, 1 << 63, size, dtype=np.uint64)
            for _ in range(copies):
                kept = base[rng.random(size) > rng.choice([0.02, 0.1, 0.2])]
                more = rng.integers(0, 1 << 63, rng.integers(0, 2 + size // 12), dtype=np.uint64)
                sets.append(np.unique(np.concatenate([kept, more, common])))
    for frequent in (np.zeros(0, "<u8"), np.sort(common[:7])):
        rows = pd.DataFrame([(int(np.uint64(key).astype(np.int64)), sig, len(found), pos) for sig, found in enumerate(sets)
                             for pos, key in enumerate(jaccard.prefix(found, frequent))], columns=["key", "sig", "n", "pos"])
        rows = rows.sort_values("key", kind="stable", ignore_index=True)
        cuts = sorted({0, len(rows), *rng.integers(0, len(rows), 25).tolist()})
        found = pd.concat(jaccard._with_pivots(iter([rows[:0], *(rows[a:b] for a, b in zip(cuts, cuts[1:]))])))
        first = set(found[found.kind == 0][["a", "b"]].itertuples(index=False, name=None))
        longer = found[found.kind == 1].rename(columns={"a": "sig"}).assign(root=lambda x: x.sig)[["key", "sig", "n", "pos", "root"]]
        assert len(longer) == sum(count for count in rows.groupby("key").size() if count > 2)
        if with_bits:
            longer["bits"] = [jaccard.parities(sets[sig]).view(np.int64) for sig in longer.sig]
        second = set(pd.concat(jaccard._across(iter([longer[:70], longer[70:]]))).itertuples(index=False, name=None))
        similar = {(a, b) for b in range(len(sets)) for a in range(b)
                   if 5 * len(np.intersect1d(sets[a], sets[b])) >= 4 * len(np.union1d(sets[a], sets[b]))}
        assert len(similar) > 100 and similar <= first | second and len(first | second) < len(sets) * (len(sets) - 1) // 2


def test_parities_rule_out_unlike_sets_of_any_size_and_no_similar_ones(spark):
    """Pairs just within and beyond the limit; sizes on both sides of a power of two, where classes are folded."""
    rng = np.random.default_rng(2)
    sets, pairs = [], []
    for n, m, shared in [(9, 9, 8), (9, 9, 1), (70, 60, 58), (2100, 2040, 1840), (2040, 1700, 1663), (2040, 1700, 0),
                         (4096, 4097, 3642), (5000, 5200, 3000), (5000, 5200, 100), (3, 4000, 3), (1, 1, 0), (60, 75, 60)]:
        hashes = rng.integers(0, 1 << 63, n + m - shared, dtype=np.uint64)
        pairs.append((len(sets), len(sets) + 1))
        sets += [np.sort(hashes[:n]), np.sort(hashes[n - shared:])]
    similar = {(a, b) for a, b in pairs if 5 * len(np.intersect1d(sets[a], sets[b])) >= 4 * len(np.union1d(sets[a], sets[b]))}
    prints = spark.createDataFrame([(k, len(x), jaccard.parities(x).view(np.int64).tolist()) for k, x in enumerate(sets)],
                                   "sig long, n int, bits array<long>")
    got = {tuple(r) for r in jaccard._possible(spark.createDataFrame(pairs, "a long, b long"), prints).collect()}
    assert len(similar) == 6 and similar <= got
    # Long unlike sets are ruled out too, as classes follow the sizes.
    assert not got & {(10, 11), (14, 15), (16, 17), (18, 19)}


@pytest.mark.parametrize("at_once", [0, 1])
def test_few_pairs_are_compared_at_once(spark, at_once, monkeypatch):
    """With no more pairs than sets one comparison for each of both passes does; rounds give the same components."""
    asked, similar = [], jaccard._similar
    monkeypatch.setattr(jaccard, "PAIRS_AT_ONCE", at_once)
    monkeypatch.setattr(jaccard, "_similar", lambda *args: asked.append(1) or similar(*args))
    rng = random.Random(1)
    rows = []
    for group in range(8):
        base = [f"g{group}w{k}" for k in range(60)]
        rows += [(10 * group + k, " ".join([*base, *(f"end{rng.random()}" for _ in range(k))])) for k in range(4)]
    sets = sets_by_force(rows + [(500 + k, f"text {k} of its own") for k in range(100)])
    links = [(a, b) for a in sets for b in sets if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    got = jaccard.near_duplicates(docs_of(spark, rows + [(500 + k, f"text {k} of its own") for k in range(100)])).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == union_find(sets, links)
    assert len(asked) == 2 if at_once else len(asked) > 2


def test_the_sample_for_frequent_shingles_grows_with_the_rows(spark, monkeypatch):
    """A shingle of many sets is told as frequent however many sets there are beside them."""
    asked, sample = [], jaccard.bounded_sample
    monkeypatch.setattr(jaccard, "SAMPLE_DOCS", 10)
    monkeypatch.setattr(jaccard, "bounded_sample", lambda df, keys, rows: asked.append(rows) or sample(df, keys, rows))
    rows = spark.range(2000).select(F.col("id").alias("doc_id"), F.concat(F.lit("the very same opening words "), F.col("id")).alias("text"),
                                    F.lit(0).cast("long").alias("text_hash"))
    assert len(jaccard._frequent(rows)) == 1 and asked == [2000 * jaccard.FREQUENT // jaccard.WIDE]


def test_fingerprints_within_four_bits_are_candidates(spark, monkeypatch):
    """The stage links copies that only fingerprints put forward; a pair within the bits that shares too little is no link."""
    rng = random.Random(5)
    values = [rng.getrandbits(63) for _ in range(6)]
    fps = [v ^ sum(1 << bit for bit in rng.sample(range(60), k)) for v in values for k in (0, 0, 3, 4, 9)]
    prints = spark.createDataFrame([(100 + k, fp) for k, fp in enumerate(fps)], "sig long, fp long")
    near = [(100 + a, 100 + b) for b in range(len(fps)) for a in range(b) if (fps[a] ^ fps[b]).bit_count() <= 4]
    got = [(r["a"], r["b"]) for r in jaccard._by_fingerprint(prints).collect()]
    nodes = [r["sig"] for r in prints.collect()]
    assert near and set(got) <= set(near) and union_find(nodes, got) == union_find(nodes, near)

    def no_pairs(frames):
        for frame in frames:
            yield frame[:0].rename(columns={"sig": "a"}).assign(kind=0, b=0)[["kind", "key", "a", "b", "n", "pos"]]

    monkeypatch.setattr(jaccard, "_with_pivots", no_pairs)
    base = [f"w{k}" for k in range(400)]
    rows = [(1, " ".join(base)), (2, " ".join([*base, "end"])), (3, "other words of one text here")]
    found = {r["doc_id"]: r["component_id"] for r in jaccard.near_duplicates(docs_of(spark, rows)).collect()}
    assert found == {1: 1, 2: 1, 3: 3}


def test_stars_take_no_round(spark, monkeypatch):
    def no_round(links):
        raise AssertionError("links that are stars went through a round")

    monkeypatch.setattr(components_module, "_toward_least", no_round)
    links = spark.createDataFrame([(1, 5), (7, 1), (9, 8), (8, 9), (3, 3)], "a long, b long")
    assert {r["node"]: r["component"] for r in components(links).collect()} == {1: 1, 5: 1, 7: 1, 8: 8, 9: 8}


def test_the_stage_drops_edited_copies(spark):
    rng = random.Random(3)
    base = [[f"w{rng.randrange(500)}" for _ in range(70)] for _ in range(20)]
    copies = [[*text[:30], "edited", *text[31:]] for text in base]
    rows = list(enumerate(" ".join(text) for text in base + copies))
    stage = dict(corpus_pipeline.STAGES)["simhash_dedup"]
    assert sorted(r["doc_id"] for r in stage(spark, docs_of(spark, rows), "").collect()) == list(range(20))


# --- recurring passages ----------------------------------------------------------------------------------------

def removed_by_force(rows):
    size, counts = substrings.WINDOW, Counter()
    words = [(k, WORDS.findall(text or "")) for k, text in rows]
    for _, w in words:
        counts.update(tuple(w[k:k + size]) for k in range(len(w) - size + 1))
    out = Counter()
    for doc, w in words:
        gone = set()
        for k in range(len(w) - size + 1):
            if counts[tuple(w[k:k + size])] > 1:
                gone.update(range(k, k + size))
        out[doc, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)] += 1
    return out


def passage_rows(seed):
    rng = random.Random(seed)
    words = ["a", "b", "é", "the", "x\x1cy", "of"] + [f"w{k}" for k in range(60)]

    def some(count):
        return [rng.choice(words) for _ in range(count)]
    shared = [some(size) for size in (34, 35, 36, 50, 90)]
    rows = [(0, None), (1, ""), (2, " \n"), (3, "be " * 40), (4, "be " * 34), (5, "a b c " * 30), (6, " ".join(some(35)))]
    for k in range(7, 60):
        text = some(rng.randrange(80))
        for _ in range(rng.randrange(3)):
            text += rng.choice(shared) + some(rng.randrange(30))
        rows.append((k, rng.choice([" ", "\n", "\t "]).join(text)))
    rows += [(60, rows[20][1]), (None, rows[21][1]), (22, rows[22][1]), (61, " ".join(some(400)))]
    edited = rows[-1][1].split(" ")
    edited[200] = "edited"
    return rows + [(62, " ".join(edited))]


@pytest.mark.parametrize("hot, block", [(5_000, 2_000), (2, 7)])
def test_removal_agrees_with_all_windows(spark, monkeypatch, hot, block):
    """Also where anchors count as hot and shards are cut into many blocks."""
    rows = passage_rows(6)
    frame = docs_of(spark, rows)
    monkeypatch.setattr(substrings, "HOT", hot)
    monkeypatch.setattr(substrings, "BLOCK_ROWS", block)
    got = Counter(tuple(r) for r in substrings.without_repeats(frame).collect())
    assert got == removed_by_force(rows)
    assert substrings.without_repeats(frame.where("false")).count() == 0


def test_rows_repeated_many_times_with_passages_inside(spark):
    rng = random.Random(9)
    shared, text = (" ".join(f"w{rng.randrange(900)}" for _ in range(size)) for size in (60, 200))
    rows = [(1, f"{shared} {text} {shared}")] * 400 + [(2, f"{text[:300]} and {shared}"), (3, "left alone " * 10)]
    assert Counter(tuple(r) for r in substrings.without_repeats(docs_of(spark, rows)).collect()) == removed_by_force(rows)


def test_hot_windows_and_blocks_in_the_shards(monkeypatch):
    """The steps inside tasks, run here so that the small limits surely hold."""
    monkeypatch.setattr(substrings, "HOT", 1)
    monkeypatch.setattr(substrings, "BLOCK_ROWS", 3)
    text = "be " * 50 + " ".join(f"w{k}" for k in range(40))
    runs = [dict(anchor=int(a), start=int(s), n=int(n), role=substrings.EDGE, alike=9)
            for a, _, s, n, _ in zip(*substrings.runs(text))]
    frame = pd.DataFrame({"key": [1, 2], "text": [text, text], "runs": [runs, runs]})
    segments = pd.concat(substrings._segments_of(iter([frame]))).sort_values(["anchor", "salt"])
    located = pd.concat(substrings._located(iter([segments[:5], segments[5:]])))
    starts = {(key, start + k) for key, start, n in located.itertuples(index=False) for k in range(n)}
    assert starts == {(key, k) for key in (1, 2) for k in range(90 - substrings.WINDOW + 1)}


def test_equal_windows_have_equal_anchors():
    rng = random.Random(8)
    passage = [f"p{k}" for k in range(60)]
    anchors = []
    for _ in range(5):
        before = [f"n{rng.randrange(999)}" for _ in range(rng.randrange(50))]
        anchor, _, start, n, _ = substrings.runs(" ".join(before + passage + before[:7]))
        of_window = np.repeat(anchor, n)
        assert (np.cumsum(n) - n == start).all()
        anchors.append(of_window[len(before):len(before) + 26].tolist())
    assert all(a == anchors[0] for a in anchors)


# --- top-k -----------------------------------------------------------------------------------------------------

def top_by_force(rows, k):
    whole = {}
    for vec_id, vector in rows:
        if vec_id is not None and vector and all(x is not None and np.isfinite(x) for x in vector):
            whole.setdefault(vec_id, []).append([int(np.floor(64 * float(x))) for x in vector])
    out = set()
    for query in whole:
        if query % 20 == 0:
            own = min(whole[query])
            scored = sorted((-sum(a * b for a, b in zip(own, v)), other) for other, all_v in whole.items()
                            for v in all_v if other != query and len(v) == len(own))
            out.update((query, rank, other, -score) for rank, (score, other) in enumerate(scored[:k], 1))
    return out


@pytest.mark.parametrize("block, chunk, high", [(4096, 2048, 0.6), (16, 3, 0.1), (16, 3, 2.0)])
def test_top_products_agree_with_all_products(spark, monkeypatch, block, chunk, high):
    rng = random.Random(9)
    rows = [(k, [rng.gauss(0, 1) * rng.choice([0.1, 1, 4]) for _ in range(8)]) for k in range(160)]
    rows += [(k, rows[20][1]) for k in range(160, 170)]                                   # ties
    rows += [(200, None), (201, []), (202, [None] * 8), (203, [float("nan")] * 8), (204, [float("inf")] * 8),
             (None, [1.0] * 8), (220, [1.0, 2.0]), (221, [3.0, 1.0]), (240, [0.0] * 8), (7, [9.0] * 8), (40, [0.5] * 8),
             (300, [2.0 ** 22] * 8), (301, [-(2.0 ** 22)] * 8)]
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "CHUNK", chunk)
    monkeypatch.setattr(topk, "HIGH_COSINE", high)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("norm", F.lit("own"))
    got = topk.top_products(frame, F.col("vec_id") % 20 == 0, 5).select("query_id", "rank", "vec_id", "score")
    assert {tuple(r) for r in got.collect()} == top_by_force(rows, 5)
    assert topk.top_products(frame.where("false"), F.col("vec_id") % 20 == 0, 5).count() == 0


@pytest.mark.parametrize("high", [0.0, 2.0])
def test_pruning_by_coordinates_and_by_length_lose_nothing(high, monkeypatch):
    monkeypatch.setattr(topk, "HIGH_COSINE", high)
    rng = np.random.default_rng(10)
    vectors = rng.integers(-50, 50, (300, 6))
    vectors[:40] = vectors[40] + rng.integers(-2, 3, (40, 6))
    block = pd.DataFrame({"candidate": np.arange(300), "w": list(vectors), "length": np.sqrt((vectors ** 2).sum(1))})
    for at in range(0, 300, 20):
        scores = vectors @ vectors[at]
        order = sorted((-s, k) for k, s in enumerate(scores) if k != at)[:5]
        chunk = pd.DataFrame({"vec_id": [at], "v": [vectors[at]], "norm": block["length"][at:at + 1].to_numpy(), "bound": [-float(order[-1][0])]})
        got = topk._search(block, chunk, 5)
        assert [(-s, k) for _, k, s in got.itertuples(index=False)] == order


# --- queries and pipeline ----------------------------------------------------------------------------------------

def test_each_operator_has_one_query():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in queries.QUERIES) == list(range(1, 11))
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


def test_stages_keep_columns_and_clean_documents(spark, tmp_path):
    rng = random.Random(12)
    words = [f"{a}{b}" for a in ("the", "of", "an", "ing") for b in ("", "er", "ed", "ly", "on")]
    texts = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(40)]
    item = "this very item stands in the benchmark and nowhere else"
    rows = list(enumerate(texts)) + [(50, texts[3]), (51, texts[4] + " " + item), (52, "12 34"), (53, None),
                                     (54, texts[5][:150] + " token=abcdef99 " + texts[6][:150]), (55, "")]
    folder = str(tmp_path)
    docs_of(spark, rows).withColumn("extra", F.lit("own")).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = f"{folder}/{name}"
        stage(spark, docs, folder).write.parquet(path)
        after = spark.read.parquet(path)
        assert after.columns == docs.columns
        docs = after
    assert {r["doc_id"] for r in docs.collect()} == {*range(40), 54}
    masked = docs.where("doc_id = 54").first()
    assert "[secret]" in masked["text"] and masked["n_chars"] == len(masked["text"])
    last = corpus_pipeline.run(spark, folder)
    assert {r["doc_id"] for r in last.collect()} == {*range(40), 54}
    assert last.where("n_tokens != size(ids) or n_tokens = 0").count() == 0


def test_jaccard_without_documents(spark):
    assert jaccard.near_duplicates(docs_of(spark, [(1, "a")]).where("false")).count() == 0
    assert jaccard.one_of_each_group(docs_of(spark, [(1, "a")]).where("false")).count() == 0


@pytest.mark.parametrize("rounds", [0])
def test_stars_of_any_size_and_number_of_rounds_connect_alike(spark, rounds, monkeypatch):
    monkeypatch.setattr(jaccard, "ROUNDS", rounds)
    monkeypatch.setattr(jaccard, "STAR", 2)
    rows = list(enumerate(edited_texts(), 5))
    sets = sets_by_force(rows)
    links = [(a, b) for a in sets for b in sets if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    got = jaccard.near_duplicates(docs_of(spark, rows)).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == union_find(sets, links)


def test_unlike_texts_of_one_id_both_stay(spark):
    words = [f"w{k}" for k in range(60)]
    near, far = " ".join(words), " ".join(reversed(words))
    rows = docs_of(spark, [(3, near), (3, far), (3, far), (1, near + " end"), (None, near), (None, None), (7, None), (8, "")])
    got = sorted(((r["doc_id"] or 0, r["text"]) for r in jaccard.one_of_each_group(rows).collect()), key=str)
    assert got == sorted([(0, None), (0, near), (1, near + " end"), (3, far), (7, None)], key=str)
