"""Which column types hold every value of another."""

from __future__ import annotations

import re

_DECIMAL = re.compile(r"decimal\((\d+),(\d+)\)")
# Integer types from narrow to wide.
_INTEGERS = ("tinyint", "smallint", "int", "bigint")


def widens(old: str, new: str) -> bool:
    """Whether every value of the old type fits the new one unchanged."""
    if old == new:
        return True
    if old in _INTEGERS and new in _INTEGERS:
        return _INTEGERS.index(new) > _INTEGERS.index(old)
    if (old, new) == ("float", "double"):
        return True
    before, after = _DECIMAL.fullmatch(old), _DECIMAL.fullmatch(new)
    if before and after:
        (p, s), (q, t) = (tuple(map(int, m.groups())) for m in (before, after))
        return t >= s and q - t >= p - s
    return False
