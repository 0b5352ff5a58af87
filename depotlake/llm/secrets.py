"""Secret scans from a trigram inverted index; DataFrame functions only.

Each rule's regular expression gives a Boolean trigram query (``trigrams``). The index lists, for every trigram that
some query mentions, the documents that hold it (in lower case). Postings are gathered by document into bitmaps,
the clauses of each query are intersected on them, and only the candidates of a rule are verified with its
expression. A rule without mandatory trigrams, such as long hexadecimal runs, scans every text.

Documents are known to the index by a hash of id and text: a collision can only add a candidate, never lose
one, and repeated rows share their postings.

Places are code points, ends are exclusive. Defined results: a NULL or empty text has no spans; matches of one
rule do not overlap, matches of different rules may; repeated rows give the same spans; time grows in proportion to
the spans of a text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotlake.llm.common import fresh, settled
from depotlake.llm.trigrams import trigram_query
from depotlake.operators.joins import broadcast_if_small

MASK_BITS = 60
#: Elements of an array that are gone through together; time grows with their number, not with its square.
BLOCK = 256
SPANS = "array<struct<start:int,rank:int,kind:string,stop:int>>"


@dataclass(frozen=True)
class Rule:
    """``pattern`` with matches of which group ``group`` has at least ``least`` letters."""
    kind: str
    pattern: str
    any_case: bool = False
    group: int = 0
    least: int = 0

    @property
    def java(self) -> str:
        return ("(?i)" if self.any_case else "") + self.pattern


# The three base rules, then further ones; the order ranks spans that start together. A run's least length is
# written into its expression where shorter matches cannot hide longer ones.
BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         any_case=True, group=2, least=6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
RULES = BASE_RULES + (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)


def _key(doc_id: str, text: str) -> Column:
    return F.xxhash64(doc_id, text)


def postings(docs: DataFrame, terms: list[str], text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``(key, term)`` of every document and every one of ``terms`` that it holds."""
    lower = docs.select(_key(doc_id, text).alias("key"), F.lower(text).alias("lower"))
    return lower.select("*", F.explode(F.array(*map(F.lit, terms))).alias("term")).where(
        F.contains("lower", F.col("term"))).select("key", "term")


def candidates(docs: DataFrame, rules=RULES, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``(key, rules)``: for documents that fulfil a query, bit n is set if they fulfil that of rule n."""
    queries = {n: q for n, rule in enumerate(rules) if frozenset() not in (q := trigram_query(rule.pattern))}
    terms = sorted({term for query in queries.values() for clause in query for term in clause})
    if not terms:
        return docs.select(_key(doc_id, text).alias("key"), F.lit(0).alias("rules")).limit(0)
    groups = [terms[k:k + MASK_BITS] for k in range(0, len(terms), MASK_BITS)]

    def bit(group: list[str]) -> Column:
        value = F.lit(0).cast("long")
        for k, term in enumerate(group):
            value = F.when(F.col("term") == term, F.lit(1 << k).cast("long")).otherwise(value)
        return value

    def holds(clause: frozenset[str]) -> Column:
        parts = []
        for g, group in enumerate(groups):
            wanted = sum(1 << k for k, term in enumerate(group) if term in clause)
            if wanted:
                parts.append(F.col(f"m{g}").bitwiseAND(F.lit(wanted)) == F.lit(wanted))
        everything = parts[0]
        for part in parts[1:]:
            everything = everything & part
        return everything

    masks = postings(docs, terms, text, doc_id).groupBy("key").agg(
        *[F.bit_or(bit(group)).alias(f"m{g}") for g, group in enumerate(groups)])
    fulfilled = F.lit(0)
    for n, query in queries.items():
        any_clause = holds(query[0])
        for clause in query[1:]:
            any_clause = any_clause | holds(clause)
        fulfilled = fulfilled + F.when(any_clause, F.lit(1 << n)).otherwise(F.lit(0))
    return masks.select("key", fulfilled.alias("rules")).where("rules > 0")


def _let(value: Column, function) -> Column:
    """``function`` of ``value``, which is worked out once however often ``function`` names it."""
    return F.element_at(F.transform(F.array(value), function), 1)


def _blocks(values: Column) -> Column:
    """An array that is not empty, cut into arrays of ``BLOCK`` elements."""
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / BLOCK).cast("int")),
                       lambda block: F.slice(values, block * BLOCK + 1, F.lit(BLOCK)))


def _running(values: Column, merge) -> Column:
    """What the elements up to each one come to under ``merge``, from 0. Arrays grow within a block only."""
    def grown(block: Column, value) -> Column:
        return F.aggregate(block, F.array().cast("array<int>"), lambda done, item: F.concat(done, F.array(
            merge(F.coalesce(F.try_element_at(done, F.lit(-1)), F.lit(0)), value(item)))))

    def joined(blocks: Column) -> Column:
        before = F.concat(F.array(F.lit(0)), grown(blocks, lambda block: F.element_at(block, -1)))
        return F.flatten(F.zip_with(blocks, F.slice(before, F.lit(1), F.size(blocks)), lambda block, offset: F.transform(
            block, lambda item: merge(offset, item))))

    return _let(F.transform(_let(values, _blocks), lambda block: grown(block, lambda item: item)), joined)


def _matches(text: Column, rule: Rule, rank: int) -> Column:
    """The spans of one rule: what lies between matches and the matches themselves add up to the places."""
    pattern = F.lit(rule.java)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    tested = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else whole
    pieces = F.zip_with(
        F.split(text, rule.java, -1), F.arrays_zip(whole.alias("whole"), tested.alias("tested")),
        lambda gap, hit: F.struct(F.length(gap).alias("gap"), F.coalesce(F.length(hit["whole"]), F.lit(0)).alias("whole"),
                                  F.coalesce(F.length(hit["tested"]), F.lit(0)).alias("tested")))
    least = max(rule.least, 1)

    def spans(found: Column) -> Column:
        stops = _running(F.transform(found, lambda piece: piece["gap"] + piece["whole"]), lambda a, b: a + b)
        placed = F.filter(F.zip_with(found, stops, lambda piece, stop: F.struct(
            piece["whole"].alias("whole"), piece["tested"].alias("tested"), stop.alias("stop"))),
            lambda piece: piece["tested"] >= least)
        return F.transform(placed, lambda piece: F.struct(
            (piece["stop"] - piece["whole"]).alias("start"), F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"),
            piece["stop"].alias("stop")))

    return _let(pieces, spans)


def with_spans(docs: DataFrame, spans: str, rules=RULES, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with the column ``spans``, ordered by start, then by rule."""
    key, mask = fresh(docs, "key"), fresh(docs, "rules")
    found = candidates(docs, rules, text, doc_id).select(F.col("key").alias(key), F.col("rules").alias(mask))
    # Written once, as its size is measured first: texts stay where they are unless the candidates are too many to send.
    found = settled(found, "secret-candidates")
    joined = docs.withColumn(key, _key(doc_id, text)).join(broadcast_if_small(found), key, "left")
    none = F.array().cast(SPANS)
    content = F.coalesce(F.col(text), F.lit(""))
    parts = []
    for n, rule in enumerate(rules):
        part = _matches(content, rule, n)
        if frozenset() not in trigram_query(rule.pattern):
            part = F.when(F.coalesce(F.col(mask), F.lit(0)).bitwiseAND(F.lit(1 << n)) != 0, part).otherwise(none)
        parts.append(part)
    return joined.withColumn(spans, F.array_sort(F.concat(*parts))).drop(key, mask)


def listed(spans: Column) -> Column:
    """``kind:start:end`` of spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda span: F.concat_ws(
        ":", span["kind"], span["start"].cast("string"), span["stop"].cast("string"))), ",")


def redacted(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", mark: str = "[secret]",
             rules=RULES) -> DataFrame:
    """``docs`` with every span replaced by ``mark``; spans that overlap become one mark. NULL stays NULL."""
    spans = fresh(docs, "spans")
    content = F.col(text)

    def cut(gaps: Column) -> Column:
        """The gaps of a block, each with a mark behind it; places count from the block's own piece of text."""
        first = F.element_at(gaps, 1)["from"]
        piece = F.substring(content, first + 1, F.element_at(gaps, -1)["upto"] - first)
        return _let(piece, lambda part: F.array_join(F.transform(gaps, lambda gap: F.concat(
            F.substring(part, gap["from"] - first + 1, gap["upto"] - gap["from"]), F.lit(mark))), ""))

    def masked(reach: Column) -> Column:
        before = F.concat(F.array(F.lit(0)), F.slice(reach, F.lit(1), F.size(reach) - 1))
        gaps = F.filter(F.zip_with(F.col(spans), before, lambda span, done: F.struct(
            done.alias("from"), span["start"].alias("upto"))), lambda gap: gap["upto"] >= gap["from"])
        rest = F.substring(content, F.element_at(reach, -1) + 1, F.length(content))
        return F.concat(F.array_join(F.transform(_let(gaps, _blocks), cut), ""), rest)

    clean = _let(_running(F.transform(spans, lambda span: span["stop"]), F.greatest), masked)
    changed = F.when(F.size(spans) > 0, clean).otherwise(content)
    return with_spans(docs, spans, rules, text, doc_id).withColumn(text, changed).drop(spans)
