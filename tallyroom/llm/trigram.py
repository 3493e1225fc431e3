"""Boolean trigram queries that every match of a regular expression must satisfy."""

from __future__ import annotations

import re
from itertools import product

#: Largest set of alternative strings that is followed through a concatenation.
_MOST = 64

#: A query in disjunctive form: a match needs all trigrams of at least one clause. {frozenset()} is
#: met by every text.
Query = frozenset[frozenset[str]]
ANY: Query = frozenset({frozenset()})

_parser = re._parser  # type: ignore[attr-defined]


def _grams(strings: set[str]) -> Query:
    return _least({frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings})


def _least(clauses: set[frozenset[str]]) -> Query:
    """Without clauses that another one implies."""
    return frozenset(c for c in clauses if not any(d < c for d in clauses))


def _both(a: Query, b: Query) -> Query:
    if len(a) * len(b) > _MOST:
        return a if len(a) < len(b) else b
    return _least({x | y for x, y in product(a, b)})


def _choices(op, arg) -> set[str] | None:
    """The strings that one parsed item stands for, if they are few; letters folded to lower case."""
    name = str(op)
    if name == "LITERAL":
        return {chr(arg).lower()}
    if name == "IN" and all(str(o) == "LITERAL" for o, _ in arg):
        return {chr(c).lower() for _, c in arg}
    if name == "MAX_REPEAT" and arg[1] == 1 and arg[0] in (0, 1):
        inner = _strings(arg[2])
        return None if inner is None else inner | ({""} if arg[0] == 0 else set())
    if name == "SUBPATTERN":
        return _strings(arg[3])
    if name == "BRANCH":
        each = [_strings(b) for b in arg[1]]
        return None if any(e is None for e in each) else set().union(*each)
    return None


def _strings(items) -> set[str] | None:
    out = {""}
    for op, arg in items:
        more = _choices(op, arg)
        if more is None or len(out) * len(more) > _MOST:
            return None
        out = {a + b for a, b in product(out, more)}
    return out


def _inside(op, arg) -> Query:
    """The query of one item that is more than a few strings."""
    name = str(op)
    if name == "SUBPATTERN":
        return _sequence(arg[3])
    if name == "BRANCH":
        return _least(set().union(*(_sequence(b) for b in arg[1])))
    if name in ("MAX_REPEAT", "MIN_REPEAT") and arg[0] >= 1:
        return _sequence(arg[2])
    return ANY


def _sequence(items) -> Query:
    query, run = ANY, {""}
    for op, arg in items:
        more = _choices(op, arg)
        if more is not None and len(run) * len(more) <= _MOST:
            run = {a + b for a, b in product(run, more)}
            continue
        query = _both(query, _grams(run))
        run = {""} if more is None else more
        if more is None:
            query = _both(query, _inside(op, arg))
    return _both(query, _grams(run))


def trigram_query(pattern: str) -> Query:
    """Trigrams are over the text with A-Z in lower case; ``ANY`` if the pattern has none that is certain."""
    return _sequence(_parser.parse(pattern))
