"""Boolean trigram queries of regular expressions.

A query is a list of alternatives, each a set of trigrams that must all occur;
``None`` means that nothing is mandatory and texts have to be scanned in full.
Trigrams are those of the text in lower case, so case never hides a match.
"""

from __future__ import annotations

from re import _constants as sre
from re import _parser

#: Strings kept apart while a concatenation is read; beyond it the query gets weaker, never wrong.
MOST_STRINGS = 64

Query = list[frozenset[str]] | None


def _of_strings(strings: set[str]) -> Query:
    """Any of the strings occurs."""
    found = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}
    return None if frozenset() in found else _least(found)


def _least(found: set[frozenset[str]]) -> Query:
    return sorted((a for a in found if not any(b < a for b in found)), key=sorted)


def _both(a: Query, b: Query) -> Query:
    if a is None or b is None:
        return a or b
    if len(a) * len(b) > MOST_STRINGS:
        return min(a, b, key=len)
    return _least({x | y for x in a for y in b})


def _either(queries: list[Query]) -> Query:
    return None if None in queries else _least({x for q in queries for x in q})


def _read(pattern) -> tuple[set[str] | None, Query]:
    """All strings of a pattern if they are few, and what any match must contain."""
    strings: set[str] | None = {""}
    exact, query = True, None

    def add(more: set[str] | None, needs: Query) -> None:
        nonlocal strings, exact, query
        if more is not None and len(strings) * len(more) <= MOST_STRINGS:
            strings = {a + b for a in strings for b in more}
            return
        query = _both(_both(query, _of_strings(strings)), needs if more is None else _of_strings(more))
        strings, exact = {""}, False

    for op, value in pattern:
        if op is sre.LITERAL:
            add({chr(value).lower()}, None)
        elif op is sre.IN:
            chars = _characters(value)
            add(chars, None)
        elif op is sre.SUBPATTERN:
            add(*_read(value[3]))
        elif op is sre.BRANCH:
            parts = [_read(p) for p in value[1]]
            union = None if any(s is None for s, _ in parts) else set().union(*[s for s, _ in parts])
            add(union, _either([q if s is None else _of_strings(s) for s, q in parts]))
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            low, high, inner = value
            more, needs = _read(inner)
            if more is not None and (low, high) == (0, 1):
                add(more | {""}, None)
                continue
            for _ in range(min(low, 3)):
                add(more, needs)
            if low != high or low > 3:
                add(None, None)
        elif op is sre.AT:
            continue
        else:
            add(None, None)
    if exact:
        return strings, _of_strings(strings)
    return None, _both(query, _of_strings(strings))


def _characters(items) -> set[str] | None:
    found: set[str] = set()
    for op, value in items:
        if op is sre.LITERAL:
            found.add(chr(value).lower())
        elif op is sre.RANGE and value[1] - value[0] < 16:
            found.update(chr(c).lower() for c in range(value[0], value[1] + 1))
        else:
            return None
    return found if len(found) <= 16 else None


def query_of(regex: str) -> Query:
    """The trigram query of a regular expression."""
    strings, query = _read(_parser.parse(regex))
    return _of_strings(strings) if strings is not None else query
