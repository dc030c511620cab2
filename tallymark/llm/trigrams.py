"""Boolean trigram queries derived from regular expressions."""

from __future__ import annotations

import re
from itertools import product

#: Exact strings and characters of a class that a derivation carries before it falls back to trigrams.
STRINGS, CLASS = 24, 8

#: A query is None (no demand), or a tuple of clauses that must all hold; a clause is a frozenset of conjunctions
#: (frozensets of trigrams), one of which must hold.
Query = tuple[frozenset[frozenset[str]], ...]


def _of_strings(strings: set[str]) -> Query:
    """What a text holding one of the strings must hold."""
    sets = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}
    sets = {s for s in sets if not any(o < s for o in sets)}
    return () if frozenset() in sets or not sets else (frozenset(sets),)


def _walk(nodes) -> tuple[set[str] | None, Query]:
    """Exact strings that the nodes can match (None: unknown), and clauses met on the way."""
    exact: set[str] | None = {""}
    clauses: list = []

    def settle():
        nonlocal exact
        if exact:
            clauses.extend(_of_strings(exact))
        exact = {""}

    whole = True
    for op, arg in nodes:
        name = str(op)
        part: set[str] | None = None
        inner: Query = ()
        if name == "LITERAL":
            part = {chr(arg).lower()}
        elif name == "IN":
            found = {chr(v).lower() for o, v in arg if str(o) == "LITERAL"}
            part = found if len(found) <= CLASS and all(str(o) == "LITERAL" for o, _ in arg) else None
        elif name == "SUBPATTERN":
            part, inner = _walk(arg[3])
        elif name == "BRANCH":
            options = [_walk(branch) for branch in arg[1]]
            if all(e is not None for e, _ in options):
                part = set().union(*(e for e, _ in options))
            else:
                each = [(*q, *(_of_strings(e) if e else ())) for e, q in options]
                if all(len(q) == 1 for q in each):
                    inner = (frozenset().union(*(q[0] for q in each)),)
        elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
            low, high, body = arg
            one, inner = _walk(body)
            if one is not None and low == high and low <= 4:
                part = {"".join(p) for p in product(one, repeat=low)} if len(one) ** low <= STRINGS else None
            elif one is not None and low == 0 and high == 1:
                part = one | {""}
            elif one is not None and low >= 1:
                clauses.extend(_of_strings(one))
            inner = inner if low >= 1 else ()
        elif name in ("AT", "ASSERT", "ASSERT_NOT"):
            continue
        clauses.extend(inner)
        if part is not None and exact is not None and len(exact) * len(part) <= STRINGS:
            exact = {a + b for a in exact for b in part}
            continue
        whole = False
        settle()
        if part is not None:
            exact = set(part)
        else:
            exact = {""}
    if whole:
        return exact, tuple(clauses)
    settle()
    return None, tuple(clauses)


def trigram_query(pattern: str) -> Query | None:
    """The clauses a lower-cased text must meet to match ``pattern``; None if the pattern demands no trigram."""
    exact, clauses = _walk(re._parser.parse(pattern))
    clauses = (*clauses, *(_of_strings(exact) if exact else ()))
    return tuple(dict.fromkeys(clauses)) or None
