"""Operators on single texts: language, quality, toxicity, BPE, secrets, licenses, decontamination."""

from __future__ import annotations

import hashlib
import math
import random
import re
import time

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from depotlake.llm import bpe, decontaminate, language, licenses, quality, queries, secrets, toxicity
from depotlake.llm.queries import TOKENIZER
from depotlake.llm.trigrams import trigram_query

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, *texts, lang="en"):
    return spark.createDataFrame([(k, text, lang, "s", 0) for k, text in enumerate(texts)], DOCS)


def levenshtein(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


# --- BPE -----------------------------------------------------------------------------------------------------

def texts_for_bpe():
    rng = random.Random(3)
    odd = ["", None, "a<|endoftext|>b  <|endoftext|>", " \n\n x\t", "é" * 700, "the" * 400, "½ ² don't 'LL", "日本 🎉🎉"]
    letters = "ab eé\n\t1'.!日🎉 ́"
    return odd + ["".join(rng.choice(letters) for _ in range(rng.randrange(80))) for _ in range(150)]


def test_bpe_agrees_with_the_library_and_returns_the_text(spark):
    from tokenizers import Tokenizer
    known = Tokenizer.from_file(TOKENIZER)
    texts = texts_for_bpe()
    rows = docs_of(spark, *texts).withColumn("ids", bpe.encoded(F.col("text"), TOKENIZER)).withColumn(
        "back", bpe.decoded(F.col("ids"), TOKENIZER)).collect()
    for row in rows:
        assert row["ids"] == known.encode(row["text"] or "", add_special_tokens=False).ids
        assert row["back"] == (row["text"] or "")


def test_round_trip_query_agrees_with_the_library(spark):
    import public_tokenizers
    from tokenizers import Tokenizer
    assert TOKENIZER == public_tokenizers.path("byte_bpe_50k.json")
    known = Tokenizer.from_file(TOKENIZER)
    table = pd.read_parquet("/root/testdata/sf0.001/documents.parquet")
    got = {row["doc_id"]: row for row in queries.QUERIES["op7_bpe"](spark, "/root/testdata/sf0.001").collect()}
    for doc_id, text in zip(table["doc_id"], table["text"]):
        ids = known.encode(text or "", add_special_tokens=False).ids
        back = known.decode(ids, skip_special_tokens=False)
        row = got[doc_id]
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(back.encode()).hexdigest()


def test_round_trip_equals_encoding_and_decoding(spark):
    rows = docs_of(spark, *texts_for_bpe(), "word " * 100_000, "x" * 50_000)
    ids = bpe.encoded(F.col("text"), TOKENIZER)
    both = rows.select(bpe.round_trip(F.col("text"), TOKENIZER).alias("t"), ids.alias("ids")).select(
        "t", "ids", bpe.decoded(F.col("ids"), TOKENIZER).alias("back")).collect()
    assert all(row["t"]["ids"] == row["ids"] and row["t"]["text"] == row["back"] for row in both)
    assert rows.where("false").select(bpe.round_trip(F.col("text"), TOKENIZER)).count() == 0


def test_long_words_take_the_same_merges():
    vocabulary = bpe.Vocabulary(TOKENIZER)
    rng = random.Random(5)
    words = [bytes(rng.choice(b"theandingre ") for _ in range(size)) for size in (1, 2, 9, 9, 60, 250) for _ in range(20)]
    for word, ids in zip(words, vocabulary.merge_all(words)):
        assert vocabulary._merge_long([vocabulary.of_byte[b] for b in word]) == bpe.np.frombuffer(ids, "i4").tolist()


def test_turning_generations_of_words_changes_nothing(monkeypatch):
    texts = [text for text in texts_for_bpe() if text] * 2
    wanted = bpe.Encoder(bpe.Vocabulary(TOKENIZER)).encode_all(texts)
    monkeypatch.setattr(bpe, "CACHED_BYTES", 1_000)
    monkeypatch.setattr(bpe, "BLOCK_CHARS", 100)
    assert bpe.Encoder(bpe.Vocabulary(TOKENIZER)).encode_all(texts) == wanted


def test_decoding_skips_unknown_ids_and_mends_broken_utf8(spark):
    from tokenizers import Tokenizer
    known = Tokenizer.from_file(TOKENIZER)
    rng = random.Random(7)
    lists = [[rng.randrange(50_257) for _ in range(30)] for _ in range(50)]
    rows = spark.createDataFrame([(ids,) for ids in [*lists, None, [], [99_999, 262]]], "ids array<int>")
    got = [row[0] for row in rows.select(bpe.decoded(F.col("ids"), TOKENIZER)).collect()]
    assert got == [known.decode(ids, skip_special_tokens=False) for ids in lists] + ["", "", known.decode([262])]


# --- secrets -------------------------------------------------------------------------------------------------

def spans_by_re(text: str) -> list[tuple]:
    found = []
    for rank, rule in enumerate(secrets.RULES):
        for match in re.finditer(rule.pattern, text, re.ASCII | (re.IGNORECASE if rule.any_case else 0)):
            if len(match[rule.group]) >= rule.least:
                found.append((match.start(), rank, rule.kind, match.end()))
    return sorted(found)


SECRET_TEXTS = [
    "", None, "token=token:abcdefgh", "password = 'hunter22' PASSWD:\"abc\"", "x" * 5000 + "API_key:abcdef",
    "é🎉 token=ABCdef123 AKIA" + "A" * 16 + " " + "a1" * 12 + " AKIAABC", "AKIAKIA" + "Z" * 20, "f" * 23 + " " + "f" * 24,
    "-----BEGIN RSA PRIVATE KEY----- ghp_" + "a" * 36, "eyJabcdefgh.eyJabcdefgh.abcdefgh", "secret:\x20\x20\"abcdef\"=x",
    "token=abcdef" * 300,
]


def test_spans_agree_with_plain_expressions(spark):
    rng = random.Random(11)
    bits = ["token", "=", ":", "'", " ", "api_key", "apikey", "AKIA", "deadbeef", "0123456789", "é", "🎉", "Secret", "abc", "x_", "\n"]
    texts = SECRET_TEXTS + ["".join(rng.choice(bits) for _ in range(rng.randrange(40))) for _ in range(200)]
    for row in secrets.with_spans(docs_of(spark, *texts), "found").collect():
        assert [tuple(span) for span in row["found"]] == spans_by_re(row["text"] or ""), row["text"]


def test_every_matching_text_fulfils_the_trigram_query():
    for rule in secrets.RULES:
        for text in SECRET_TEXTS:
            if text and re.search(rule.pattern, text, re.ASCII | (re.IGNORECASE if rule.any_case else 0)):
                grams = {text.lower()[k:k + 3] for k in range(len(text))}
                assert any(clause <= grams for clause in trigram_query(rule.pattern)), (rule.kind, text)
    assert trigram_query("[0-9a-f]{24,}") == [frozenset()]
    assert trigram_query("AKIA[A-Z]+") == [frozenset({"aki", "kia"})]


def test_redaction_masks_each_group_of_spans_once(spark):
    rows = docs_of(spark, "a token=abcdef b", None, "clean", "token=" + "a1" * 12 + " é " + "b2" * 12)
    got = [row["text"] for row in secrets.redacted(rows).orderBy("doc_id").collect()]
    assert got == ["a [secret] b", None, "clean", "[secret] é [secret]"]
    assert secrets.redacted(rows).columns == rows.columns


def test_a_text_of_many_spans_takes_time_in_proportion(spark):
    count = 100_000
    text = "é token=abcdef," * count
    rows = docs_of(spark, text).cache()
    rows.count()
    start = time.monotonic()
    spans = secrets.with_spans(rows, "found").selectExpr("size(found) n", "found[77777] s", "found[99999] t").first()
    clean = secrets.redacted(rows).first()["text"]
    assert time.monotonic() - start < 60  # quadratic: some minutes for the spans alone
    size = len("é token=abcdef,")
    assert spans["n"] == count and [spans[k]["start"] for k in "st"] == [77777 * size + 2, 99999 * size + 2]
    assert clean == "é [secret]," * count
    rows.unpersist()


def test_many_spans_of_several_rules_that_overlap(spark):
    rng = random.Random(3)
    bits = ["token=", "a1" * 12, "deadbeef" * 3, " ", "é", "AKIA" + "Q" * 16, "🎉", "x"]
    texts = ["".join(rng.choice(bits) for _ in range(n)) for n in (1500, 3000)]
    for row in secrets.with_spans(docs_of(spark, *texts), "found").collect():
        assert [tuple(span) for span in row["found"]] == spans_by_re(row["text"])
    for row, text in zip(secrets.redacted(docs_of(spark, *texts)).orderBy("doc_id").collect(), texts):
        out, at = "", 0
        for start, _, _, stop in spans_by_re(text):
            if start >= at:
                out += text[at:start] + "[secret]"
            at = max(at, stop)
        assert row["text"] == out + text[at:]


def test_candidates_too_many_to_send_are_joined_by_key(spark, monkeypatch):
    rows = docs_of(spark, *SECRET_TEXTS)
    sent = secrets.with_spans(rows, "found")
    monkeypatch.setattr(secrets, "broadcast_if_small", lambda found: found.hint("merge"))
    joined = secrets.with_spans(rows, "found")
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in (sent, joined)]
    assert "BroadcastHashJoin" in plans[0] and "SortMergeJoin" in plans[1]
    assert sorted(sent.collect(), key=lambda row: row["doc_id"]) == sorted(joined.collect(), key=lambda row: row["doc_id"])


def test_scans_take_clashing_columns_repeated_rows_and_empty_tables(spark):
    rows = docs_of(spark, "token=abcdef").withColumns({"key": F.lit(1), "rules": F.lit(2), "spans": F.lit(3)})
    twice = secrets.redacted(rows.union(rows)).collect()
    assert [(row["key"], row["rules"], row["spans"], row["text"]) for row in twice] == [(1, 2, 3, "[secret]")] * 2
    assert secrets.with_spans(rows.where("false"), "found").count() == 0


# --- licenses ------------------------------------------------------------------------------------------------

def licenses_by_force(text: str) -> dict[str, tuple[float, int]]:
    def cut(value):
        return [word for word in re.split(r"[\W_]+", value.lower()) if word]
    words, out = cut(text), {}
    for name, notice in licenses.NOTICES.items():
        own = cut(notice)
        size = min(licenses.SHINGLE, len(own))
        shingles = [tuple(own[k:k + size]) for k in range(len(own) - size + 1)]
        held = [tuple(words[k:k + size]) for k in range(len(words) - size + 1)]
        for at in range(0, len(held), len(shingles)):
            window = held[at:at + 2 * len(shingles)]
            share = len(set(shingles) & set(window)) / len(set(shingles))
            first = next((at + k for k, one in enumerate(window) if one in shingles), None)
            if share >= licenses.LEAST and (name not in out or (share, -first) > (out[name][0], -out[name][1])):
                out[name] = share, first
    return out


def test_licenses_agree_with_all_windows(spark):
    rng = random.Random(13)
    words = "the of work this license under public a is".split()
    texts = [None, "", "rights reserved", "All  RIGHTS reserved!"]
    for notice in licenses.NOTICES.values():
        noise = [" ".join(rng.choice(words) for _ in range(rng.randrange(40))) for _ in range(2)]
        texts += [f"{noise[0]} {notice}\n{noise[1]}", notice + " " + notice, " ".join(notice.split()[:-3])]
    found = {}
    rows = docs_of(spark, *texts)
    for row in licenses.licenses(rows.union(rows)).collect():
        assert (row["doc_id"], row["license"]) not in found
        found[row["doc_id"], row["license"]] = row["share"], row["word_at"]
    assert found == {(k, name): hit for k, text in enumerate(texts) for name, hit in licenses_by_force(text or "").items()}
    assert licenses.licenses(rows.where("false")).count() == 0


def test_excerpts_of_licenses_are_found_by_their_paragraphs(spark):
    notices = licenses.NOTICES
    body = (f"MIT License\n\nCopyright (c) 2020 Somebody\n\n{notices['mit/permission']}\n\nThe above copyright notice and "
            f"this permission notice shall be included in all copies.\n\n{notices['mit/warranty']}")
    commented = "\n".join(f" * {line}" for line in notices["apache-2.0/header"].replace(". ", ".\n").split("\n"))
    texts = [body, body[len(body) // 2:], commented, f"code() {notices['gpl-3.0/header']} more " * 3, "We grant no permission."]
    got = {(r["doc_id"], r["license"]) for r in licenses.licenses(docs_of(spark, *texts)).collect()}
    assert got == {(0, "mit/permission"), (0, "mit/warranty"), (1, "mit/warranty"), (2, "apache-2.0/header"), (3, "gpl-3.0/header")}


# --- decontamination -----------------------------------------------------------------------------------------

def test_myers_is_the_least_distance_to_any_part():
    rng = random.Random(17)
    for _ in range(150):
        pattern = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 9)))
        text = "".join(rng.choice("abc") for _ in range(rng.randrange(0, 14)))
        parts = [(levenshtein(pattern, text[a:b]), b) for b in range(len(text) + 1) for a in range(b + 1)]
        assert decontaminate.myers(pattern, text) == min(parts)


def test_matches_agree_with_all_places(spark):
    rng = random.Random(19)
    items = ["".join(rng.choice("abcde ") for _ in range(60)).strip() for _ in range(4)] + ["short one", None, "short one"]
    texts = [None, "", "Short   ONE", "a shorx one"]
    for item in items[:4]:
        for edits in range(6):
            letters = list(item)
            for _ in range(edits):
                letters[rng.randrange(len(letters))] = rng.choice("abcde")
            texts.append("zz " + "".join(letters) + " yy " * rng.randrange(3))
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["distance"] for r in decontaminate.contaminated(docs_of(spark, *texts), benchmark).collect()}
    wanted = {}
    for d, text in enumerate(texts):
        for i, item in enumerate(items):
            if text and item:
                best, _ = decontaminate.myers(decontaminate.folded(item), decontaminate.folded(text))
                if best <= int(len(decontaminate.folded(item)) * decontaminate.BUDGET):
                    wanted[d, i] = best
    assert got == wanted and len(wanted) > 10
    rows = docs_of(spark, *texts).withColumn("hits", F.lit("own"))
    kept = decontaminate.decontaminated(rows, benchmark)
    assert kept.columns == rows.columns
    assert {r["doc_id"] for r in kept.collect()} == set(range(len(texts))) - {d for d, _ in wanted}
    assert decontaminate.decontaminated(rows, benchmark.where("false")).count() == len(texts)
    assert decontaminate.contaminated(rows.where("false"), benchmark).count() == 0


def test_places_hold_the_match(spark):
    benchmark = spark.createDataFrame([(1, "one two three four five six seven eight")], "item_id long, text string")
    row = decontaminate.contaminated(docs_of(spark, "x  One two thre four five six seven  eight y"), benchmark).first()
    assert (row["distance"], row["start_at"], row["end_at"]) == (1, 2, 40)


# --- language ------------------------------------------------------------------------------------------------

def speech(rng, words, count):
    return " ".join(rng.choice(words) for _ in range(count))


@pytest.fixture(scope="module")
def tongues(spark):
    rng = random.Random(23)
    words = {"en": "the and of thing with reading".split(), "de": "der und nicht lesung keit zeit".split()}
    rows = [(k, speech(rng, words[lang], 12), lang) for k, lang in enumerate(["en", "de", "en"] * 20)]
    return spark.createDataFrame(rows + [(99, "the", None), (98, None, "fr")], "doc_id long, text string, lang string")


def test_language_words_then_grams(spark, tongues):
    model = language.learn(tongues, sample_keys=["doc_id"])
    assert model.languages == ["de", "en"]
    speaker = language.Predictor(model)
    assert speaker.predict("The reading of the thing")[0] == "en"
    assert speaker.predict("Lesungkeiten")[0] == "de"          # unseen word, known n-grams
    assert speaker.predict("日本語")[0] == "en"                  # nothing known: the most frequent one
    for text in (None, "", " 12 .,!½ ²"):
        assert speaker.predict(text) == ("und", 0.0)
    word, score = speaker.predict("der und " * 50_000)
    assert word == "de" and score == pytest.approx(1.0)


def test_language_tables_come_from_arrow_columns():
    """The driver makes no row objects of the collected counts."""
    kind = pa.list_(pa.struct([("lang", pa.string()), ("n", pa.int64())]))
    terms = pa.chunked_array([["der", "die"], [], ["the"]], pa.string())
    counts = pa.chunked_array([[[{"lang": "en", "n": 2}, {"lang": "de", "n": 5}], [{"lang": "de", "n": 4}]], [],
                               [[{"lang": "en", "n": 7}]]], kind)
    place, scores = language._log_table(pa.table({"term": terms, "by_lang": counts}), ["de", "en"])
    assert place == {"der": 0, "die": 1, "the": 2}
    held = np.array([[5, 2], [4, 0], [0, 7]]) + language.SMOOTHING
    assert np.allclose(scores, np.log(held / (np.array([9, 9]) + 3 * language.SMOOTHING)))
    nothing = pa.table({"term": pa.array([], pa.string()), "by_lang": pa.array([], kind)})
    place, scores = language._log_table(nothing, ["de"])
    assert place == {} and scores.shape == (0, 1)


@pytest.mark.parametrize("text", ["m²", "H₂O x²", "x½", "5 m²", "a_b", "ⅷa"])
def test_letters_beside_other_signs_have_a_language(spark, tongues, text):
    speaker = language.Predictor(language.learn(tongues, sample_keys=["doc_id"]))
    assert speaker.predict(text)[0] in ("de", "en")
    assert [speaker.predict(odd) for odd in ("½ ²", "_ 12", "٣", None)] == [("und", 0.0)] * 4
    rows = docs_of(spark, text).select(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0)))
    assert language.words_of(text) == rows.collect()[0][0]


def predicted_by_force(model, text):
    words = re.findall(r"[a-zäöüßéèà]+", text.lower())
    total = {lang: model.prior[k] for k, lang in enumerate(model.languages)}
    for word in words:
        rows = [model.words[word]] if word in model.words else []
        for size in range(language.LONGEST, 0, -1):
            if not rows:
                padded = f" {word} "
                rows = [model.grams[g] for at in range(max(1, len(padded) - size + 1)) if (g := padded[at:at + size]) in model.grams]
        for k, lang in enumerate(model.languages if rows else []):
            total[lang] += sum(model.scores[row][k] for row in rows) / len(rows)
    best = max(model.languages, key=lambda lang: (total[lang], -model.languages.index(lang)))
    return best, 1 / sum(math.exp(value - total[best]) for value in total.values())


def test_predictions_agree_with_plain_sums(spark, tongues):
    model = language.learn(tongues, sample_keys=["doc_id"])
    speaker = language.Predictor(model)
    for text in ["the thing", "das ding", "thingx dasz qqq", "über the", "a b c d", "Straße houses"]:
        lang, score = speaker.predict(text)
        wanted = predicted_by_force(model, text)
        assert lang == wanted[0] and score == pytest.approx(wanted[1])


def test_language_backs_off_to_the_longest_known_gram(spark, tongues):
    model = language.learn(tongues, sample_keys=["doc_id"])
    padded, found = " thingx ", None
    for size in range(language.LONGEST, 0, -1):
        rows = [model.grams[padded[k:k + size]] for k in range(len(padded) - size + 1) if padded[k:k + size] in model.grams]
        if rows:
            found = tuple(model.scores[rows].mean(axis=0))
            break
    assert language.Predictor(model).unseen("thingx") == pytest.approx(found)


def test_language_of_long_runs_shows_after_their_beginning(spark):
    """Learning and prediction take the n-grams of the whole run, over pieces."""
    rng = random.Random(23)
    first, second = (["".join(rng.choice(letters) for _ in range(2_000)) for _ in range(6)] for letters in ("abcd", "mnop"))
    opening = "abcd" * 20
    rows = [(k, text, lang, "s", 0) for k, (text, lang) in enumerate(
        [(text, "aa") for text in first] + [(opening + text, "bb") for text in second])]
    model = language.learn(spark.createDataFrame(rows, DOCS), sample_keys=["doc_id"])
    assert "mnop" in model.grams and any(f"{letter} " in model.grams for letter in "mnop")
    predictor = language.Predictor(model)
    for lang, letters in (("aa", "abcd"), ("bb", "mnop")):
        text = opening + "".join(rng.choice(letters) for _ in range(100_000))
        assert predictor.predict(text)[0] == lang and not predictor.young


def test_grams_of_pieces_are_those_of_the_word(spark):
    step = language.PIECE
    words = ["x" * k + "yz" for k in (0, 1, 3, step - 6, step - 4, step - 2, step - 1, step, step + 1, 3 * step)]
    rows = spark.createDataFrame([(f" {word} ",) for word in words], "word string").select(
        "word", F.posexplode(language._pieces(F.col("word"))).alias("at", "piece"))
    for size in range(1, language.LONGEST + 1):
        got = rows.select("word", F.explode(language._grams(F.col("piece"), F.col("at"), size)).alias("gram")).collect()
        for padded in (f" {word} " for word in words):
            wanted = [padded[k:k + size] for k in range(max(1, len(padded) - size + 1))]
            assert sorted(r["gram"] for r in got if r["word"] == padded) == sorted(wanted)


def test_nothing_to_learn_from(spark):
    empty = docs_of(spark, "a b").where("false")
    assert language.Predictor(language.learn(empty)).predict("text") == ("und", 0.0)
    labels = empty.select("text", F.lit(1).alias("label"), F.lit(0).alias("fold"))
    assert quality.learn(labels).score(quality.Pooler({}, quality.np.zeros((1, quality.SIZE))).features("x")[None]) == [0.5]
    assert toxicity.learn(labels).terms == []


# --- quality -------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def judged(spark):
    rng = random.Random(29)
    words = "the and of thing with reading house river stone light".split()
    good = [speech(rng, words, 60) + "." for _ in range(80)]
    junk = ["!! ".join(text.upper().split()) for text in good[:20]] + [f"{w} " * 40 for w in words * 2]
    rows = [(text, label, k % 5) for label, texts in ((1, good), (0, junk)) for k, text in enumerate(texts)]
    return spark.createDataFrame(rows, "text string, label int, fold int")


def test_quality_tells_junk_and_is_repeatable(spark, judged):
    model, again = quality.learn(judged), quality.learn(judged.repartition(7))
    assert [a.tolist() for a in model.layers] == [a.tolist() for a in again.layers]
    texts = ["the river and the house of stone.", "RIVER!! HOUSE!! THE!! STONE!! AND!! LIGHT!! OF!!", "house " * 30, None, "", "the " * 50_000]
    rows = docs_of(spark, *texts).select("doc_id", quality.scored(F.col("text"), model, spark).alias("p")).orderBy("doc_id").collect()
    scores = [row["p"] for row in rows]
    assert scores[0] > 0.5 > max(scores[1], scores[2])
    assert scores[3] == scores[4] and all(0 <= p <= 1 for p in scores)


def test_quality_context_sums_count_neighbours():
    import pandas as pd
    frame = next(quality.context_sums(iter([pd.DataFrame({"text": ["a b c"]})])))
    sums = dict(zip(frame["term"], frame["v"]))
    assert (sums["a"] == quality.index_vector("b") + quality.index_vector("c")).all()


# --- toxicity ------------------------------------------------------------------------------------------------

def test_automaton_is_levenshtein_over_the_lexicon():
    terms = ["idiot", "clown", "worthless", "scum", "lowei*", "trash", "trashed"]
    automaton, rng = toxicity.LexiconAutomaton(terms), random.Random(31)
    for _ in range(3000):
        word = list(rng.choice(terms).strip("*"))
        for _ in range(rng.randrange(4)):
            word[rng.randrange(len(word)):][:1] = []
            word.insert(rng.randrange(len(word) + 1), rng.choice("aeiotrsé"))
            if rng.random() < 0.5 and len(word) > 1:
                del word[rng.randrange(len(word))]
        word = "".join(word)
        near = [(0, t) for t in terms if t[-1] == "*" and word.startswith(t[:-1])]
        near += [(d, t) for t in terms if t[-1] != "*" and (d := levenshtein(word, t)) <= toxicity.edits_allowed(t)]
        assert automaton.match(word) == (min(near)[::-1] if near else None), word


def test_stems_and_words_are_merged_before_the_limit(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "MAX_TERMS", 3)
    words = [("worthless", 90), ("moronic", 80), ("gringo", 70), ("clown", 60)]
    rows = [(term, n, 0) for word, n in words for term in
            [word, *(word[:size] + "*" for size in (4, 5, 6, 7) if len(word) >= size)]]
    counted = spark.createDataFrame(rows + [(f"the{k}", 0, 9) for k in range(30)], "term string, toxic long, clean long")
    assert toxicity.learn_lexicon(counted, 0.3) == ["gringo", "moronic", "worthless"]


def test_words_keep_their_edits_beside_a_stem(spark):
    rows = [("moronic", 50, 0), ("moronics", 30, 0)] + [("moronic"[:size] + "*", 80, 0) for size in (4, 5, 6, 7)]
    counted = spark.createDataFrame(rows + [(f"the{k}", 0, 9) for k in range(30)], "term string, toxic long, clean long")
    terms = toxicity.learn_lexicon(counted, 0.3)
    assert terms == ["moro*", "moronic", "moronics"]
    automaton = toxicity.LexiconAutomaton(terms)
    assert automaton.match("morronic") == ("moronic", 1) and automaton.match("mronics")[0] in ("moronic", "moronics")
    assert automaton.match("moroness") == ("moro*", 0) and automaton.match("river") is None


def test_toxicity_learns_terms_and_misspellings_but_not_quotations(spark):
    rng = random.Random(37)
    words = "the and of thing with reading house river stone light".split()
    clean = [speech(rng, words, 30) for _ in range(160)]
    toxic = []
    for text in clean[:40]:
        said = text.split()
        for _ in range(3):
            said.insert(rng.randrange(len(said)), "moronic")
        toxic.append(" ".join(said))
    rows = [(text, label, 0) for label, texts in ((0, clean), (1, toxic)) for text in texts]
    model = toxicity.learn(spark.createDataFrame(rows, "text string, label int, fold int"))
    assert "moronic" in model.terms and "the" not in model.terms
    texts = ["so moronic", "so morronic", "the river", None, "", "the " * 40_000 + "moronic moronic", 'he said "moronic" then']
    got = docs_of(spark, *texts).select("doc_id", toxicity.scored(F.col("text"), model, spark).alias("t")).orderBy("doc_id").collect()
    scores = [row["t"]["score"] for row in got]
    assert scores[0] > scores[2] and scores[1] > scores[2] and scores[5] > scores[2]
    assert scores[2] == scores[3] == scores[4]
    assert [hit["quoted"] for hit in got[6]["t"]["hits"]] == [True]
    assert got[1]["t"]["hits"][0]["edits"] == 1
