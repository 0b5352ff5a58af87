"""DuckDB SQL that states the results of the queries SQL can express."""

from __future__ import annotations

from depotlake.llm.licenses import LEAST, NOTICES, SHINGLE
from depotlake.llm.secrets import BASE_RULES, RULES, Rule


def _any_case(pattern: str) -> str:
    """ASCII letters outside sets in either case, as RE2's own flag would fold further letters."""
    out, inside = [], 0
    for at, letter in enumerate(pattern):
        escaped = at and pattern[at - 1] == "\\"
        inside += (letter == "[") - (letter == "]")
        out.append(f"[{letter.upper()}{letter.lower()}]"
                   if letter.isascii() and letter.isalpha() and not inside and not escaped else letter)
    return "".join(out)


def _quoted(rule: Rule) -> str:
    pattern = _any_case(rule.pattern) if rule.any_case else rule.pattern
    return "'" + pattern.replace("'", "''") + "'"


def _secrets() -> str:
    finds = "\n    union all ".join(
        f"select rn, {n} as k, '{rule.kind}' as kind, {rule.least} as least, "
        f"regexp_extract_all(text, {_quoted(rule)}) as whole, "
        f"regexp_extract_all(text, {_quoted(rule)}, {rule.group}) as tested, "
        f"string_split_regex(text, {_quoted(rule)}) as gap from d" for n, rule in enumerate(RULES))
    counts = ", ".join(f"count(*) filter (kind = '{rule.kind}') as n_{rule.kind}" for rule in BASE_RULES)
    base = ", ".join(f"'{rule.kind}'" for rule in BASE_RULES)
    return f"""
with d as (select row_number() over () as rn, doc_id, coalesce(text, '') as text from documents),
finds as ({finds}),
places as (select *, unnest(range(1, len(whole) + 1)) as i from finds where len(whole) > 0),
spans as (
    select rn, k, kind,
           (list_sum(list_transform(gap[1:i], lambda x: length(x)))
            + coalesce(list_sum(list_transform(whole[1:i - 1], lambda x: length(x))), 0))::int as s,
           length(whole[i]) as size
    from places where length(tested[i]) >= least),
texts as (
    select rn, {counts},
           string_agg(concat_ws(':', kind, s, s + size), ',' order by s, k) filter (kind in ({base})) as base,
           string_agg(concat_ws(':', kind, s, s + size), ',' order by s, k) as spans
    from spans group by rn)
select doc_id, {", ".join(f"coalesce(n_{r.kind}, 0)::bigint as n_{r.kind}" for r in BASE_RULES)},
       sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from d left join texts using (rn)"""


SECRETS_SQL = _secrets()


def _licenses() -> str:
    """The share of each template's shingles in the windows of a text, without MinHash."""
    notices = ", ".join(f"('{name}', '{text}')" for name, text in sorted(NOTICES.items()))
    words = r"list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '')"
    return f"""
with t as (select license, {words} as words from (values {notices}) as n(license, text)),
sized as (select license, words, least({SHINGLE}, len(words)) as s, len(words) - least({SHINGLE}, len(words)) + 1 as m from t),
cut as (select distinct license, s, m, array_to_string(words[i + 1:i + s], ' ') as shingle
        from (select *, unnest(range(0, m)) as i from sized)),
counted as (select *, count(*) over (partition by license) as size from cut),
d as (select distinct doc_id, text, {words} as words from documents),
sizes as (select distinct s from sized),
held as (select doc_id, text, s, i, array_to_string(words[i + 1:i + s], ' ') as shingle
         from (select doc_id, text, words, s, unnest(range(0, greatest(0, len(words) - s + 1))) as i from d, sizes)),
met as (select doc_id, text, license, m, size, i, held.shingle
        from held join counted on held.s = counted.s and held.shingle = counted.shingle),
windows as (select *, i - i % m as w from met
            union all select *, i - i % m - m as w from met where i >= m),
shares as (select doc_id, text, license, w, count(distinct shingle)::double / any_value(size) as share, min(i) as word_at
           from windows group by doc_id, text, license, w),
ranked as (select *, row_number() over (partition by doc_id, text, license order by share desc, word_at) as r
           from shares where share >= {LEAST})
select doc_id, license, share, word_at::bigint as word_at from ranked where r = 1"""


LICENSES_SQL = _licenses()

TOPK_SQL = """
with v as (select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as v
           from embeddings where vec_id is not null and len(embedding) > 0
             and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scores as (select q.vec_id as query_id, c.vec_id,
                  list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::bigint as score
           from v q join v c on q.vec_id <> c.vec_id and len(q.v) = len(c.v) where q.vec_id % 20 = 0)
select query_id, rank::int as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scores)
where rank <= 20"""
