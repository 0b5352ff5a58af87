"""Boolean trigram queries of regular expressions.

A query is a list of clauses, each a set of trigrams: whatever the expression matches holds all trigrams of at
least one clause. An empty clause says that nothing is mandatory. Trigrams are lower case, so one index
serves rules of either case.
"""

from __future__ import annotations

import itertools
from re import _constants as code
from re import _parser as parser

Query = list[frozenset[str]]

ANYTHING: Query = [frozenset()]
MOST_TEXTS = 64        # beyond so many alternatives a part is treated as unknown
MOST_LETTERS = 8


def _absorbed(query: Query) -> Query:
    """Without clauses that a weaker one already covers."""
    return [c for c in dict.fromkeys(query) if not any(other < c for other in query)]


def _both(left: Query, right: Query) -> Query:
    combined = _absorbed([a | b for a, b in itertools.product(left, right)])
    return combined if len(combined) <= MOST_TEXTS else left


def _of_texts(texts: set[str]) -> Query:
    return _absorbed([frozenset(text[k:k + 3] for k in range(len(text) - 2)) for text in sorted(texts)])


def _joined(left: set[str], right: set[str]) -> set[str] | None:
    return {a + b for a in left for b in right} if len(left) * len(right) <= MOST_TEXTS else None


def _letters(members) -> set[str] | None:
    texts: set[str] = set()
    for kind, value in members:
        if kind is code.LITERAL:
            texts.add(chr(value).lower())
        elif kind is code.RANGE and value[1] - value[0] < MOST_LETTERS:
            texts.update(chr(c).lower() for c in range(value[0], value[1] + 1))
        else:
            return None
    return texts if len(texts) <= MOST_LETTERS else None


def _part(kind, value) -> tuple[set[str] | None, Query]:
    """All texts that a part can match if they are few, and its query."""
    texts, query = None, ANYTHING
    if kind is code.LITERAL:
        texts = {chr(value).lower()}
    elif kind is code.IN:
        texts = _letters(value)
    elif kind is code.SUBPATTERN:
        return _sequence(value[-1])
    elif kind is code.BRANCH:
        parts = [_sequence(option) for option in value[1]]
        if all(option is not None for option, _ in parts):
            texts = set().union(*(option for option, _ in parts))
        else:
            query = _absorbed([clause for _, option in parts for clause in option])
    elif kind is code.MAX_REPEAT:
        least, most, inner = value
        inner_texts, inner_query = _sequence(inner)
        if most == 1 and least == 0 and inner_texts is not None:
            texts = inner_texts | {""}
        elif least == most == 1:
            texts, query = inner_texts, inner_query
        elif least:
            query = inner_query
    if texts is not None and len(texts) > MOST_TEXTS:
        texts = None
    return texts, _of_texts(texts) if texts is not None else query


def _sequence(parts) -> tuple[set[str] | None, Query]:
    texts: set[str] | None = {""}
    query, exact = ANYTHING, True
    for kind, value in parts:
        own, own_query = _part(kind, value)
        longer = _joined(texts, own) if own is not None else None
        if longer is not None:
            texts = longer
            continue
        query, exact = _both(query, _of_texts(texts)), False
        texts = own if own is not None else {""}
        if own is None:
            query = _both(query, own_query)
    query = _both(query, _of_texts(texts))
    return (texts if exact else None), query


def trigram_query(pattern: str) -> Query:
    """The query of a pattern made of literals, sets, groups, alternatives and repetitions."""
    return _sequence(parser.parse(pattern))[1]
