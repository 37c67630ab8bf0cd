"""Boolean trigram queries from regular expressions.

A query is a disjunction of clauses, each a set of trigrams that a matching text must all contain
(lower-cased). ``None`` means that nothing is mandatory and every text has to be scanned.
"""

from __future__ import annotations

import re
from re import _constants as C
from re import _parser as parser

#: Sets of possible strings larger than this are given up as unknown.
MOST_STRINGS = 64


def _absorb(clauses: set[frozenset[str]]) -> frozenset[frozenset[str]]:
    return frozenset(a for a in clauses if not any(b < a for b in clauses))


def _both(a, b):
    if a is None or b is None:
        return b if a is None else a
    return _absorb({x | y for x in a for y in b})


def _either(a, b):
    return None if a is None or b is None else _absorb({*a, *b})


def _of_strings(strings: set[str]):
    """The query for "one of these strings occurs"."""
    if any(len(s) < 3 for s in strings):
        return None
    return _absorb({frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings})


def _node(op, arg) -> tuple[set[str] | None, object]:
    """(all strings the node can match, or None if unknown; query)."""
    if op is C.LITERAL:
        return {chr(arg).lower()}, None
    if op is C.IN:
        if all(o is C.LITERAL for o, _ in arg) and len(arg) <= 4:
            return {chr(a).lower() for _, a in arg}, None
        return None, None
    if op is C.SUBPATTERN:
        return _sequence(arg[3])
    if op is C.BRANCH:
        strings, query = set(), frozenset()
        for branch in arg[1]:
            s, q = _sequence(branch)
            q = q if s is None else _of_strings(s)
            strings = None if s is None or strings is None else strings | s
            query = _either(query, q)
        return (strings, None) if strings is not None and len(strings) <= MOST_STRINGS else (None, query)
    if op in (C.MAX_REPEAT, C.MIN_REPEAT):
        low, high, inner = arg
        s, q = _sequence(inner)
        if (low, high) == (0, 1) and s is not None:
            return s | {""}, None
        if low == high and s is not None and len(s) ** low <= MOST_STRINGS:
            out = {""}
            for _ in range(low):
                out = {a + b for a in out for b in s}
            return out, None
        if low == 0:
            return None, None
        return None, q if s is None else _of_strings(s)
    if op is C.AT:
        return {""}, None
    return None, None


def _sequence(nodes) -> tuple[set[str] | None, object]:
    run, query, whole = {""}, None, True
    for op, arg in nodes:
        s, q = _node(op, arg)
        if s is not None and len(run) * len(s) <= MOST_STRINGS:
            run = {a + b for a in run for b in s}
            continue
        # The run ends here: what it must contain joins the query, and a new run begins.
        query, whole = _both(_both(query, _of_strings(run)), q if s is None else None), False
        run = {""} if s is None else s
    return (run, None) if whole else (None, _both(query, _of_strings(run)))


def trigram_query(regex: str) -> list[list[str]] | None:
    """Clauses of trigrams, one of which every text that ``regex`` matches has in full; None: scan all."""
    strings, query = _sequence(parser.parse(regex, re.IGNORECASE))
    query = query if strings is None else _of_strings(strings)
    return None if query is None else sorted(sorted(c) for c in query)
