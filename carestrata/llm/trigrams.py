"""Boolean trigram queries from regular expressions.

A query is an OR of ANDs: a list of sets of trigrams, of which at least one is wholly present in any text that the
expression matches. The list with an empty set is always true: the expression has no mandatory trigram. Case is folded.
"""

from __future__ import annotations

from itertools import product
from re import _constants as C
from re import _parser

ALWAYS = [frozenset()]
MOST_STRINGS = 64


def trigram_query(pattern: str) -> list[frozenset[str]]:
    exact, clauses = sequence(_parser.parse(pattern))
    return clauses if exact is None else from_strings(exact)


def from_strings(strings: set[str]) -> list[frozenset[str]]:
    return either([frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings])


def either(clauses: list[frozenset[str]]) -> list[frozenset[str]]:
    """Without clauses that another implies."""
    distinct = sorted(set(clauses), key=lambda c: (len(c), sorted(c)))
    return [c for i, c in enumerate(distinct) if not any(d <= c for d in distinct[:i])]


def both(a: list[frozenset[str]], b: list[frozenset[str]]) -> list[frozenset[str]]:
    """The AND; if it would be long, the shorter side alone, which is weaker but still true of every match."""
    if len(a) * len(b) > MOST_STRINGS:
        return min(a, b, key=len)
    return either([x | y for x, y in product(a, b)])


def sequence(nodes) -> tuple[set[str] | None, list[frozenset[str]]]:
    """All strings the nodes match, or None and a query."""
    run, clauses, whole = {""}, ALWAYS, True
    for node in nodes:
        exact, query = single(*node)
        if exact is not None and len(run) * len(exact) <= MOST_STRINGS:
            run = {a + b for a, b in product(run, exact)}
            continue
        whole = False
        clauses = both(clauses, from_strings(run))
        if exact is None:
            clauses, run = both(clauses, query), {""}
        else:
            run = exact
    return (run, ALWAYS) if whole else (None, both(clauses, from_strings(run)))


def single(kind, value) -> tuple[set[str] | None, list[frozenset[str]]]:
    if kind is C.LITERAL:
        return {chr(value).lower()}, ALWAYS
    if kind is C.AT:
        return {""}, ALWAYS
    if kind is C.SUBPATTERN:
        return sequence(value[-1])
    if kind is C.IN:
        found: set[str] = set()
        for part, what in value:
            if part is C.LITERAL:
                found.add(chr(what).lower())
            elif part is C.RANGE and what[1] - what[0] < MOST_STRINGS:
                found |= {chr(x).lower() for x in range(what[0], what[1] + 1)}
            else:
                return None, ALWAYS
        return (found, ALWAYS) if len(found) <= 8 else (None, ALWAYS)
    if kind is C.BRANCH:
        branches = [sequence(x) for x in value[1]]
        if all(exact is not None for exact, _ in branches):
            return set().union(*[exact for exact, _ in branches]), ALWAYS
        return None, either([c for exact, q in branches for c in (q if exact is None else from_strings(exact))])
    if kind in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT):
        least, most, inner = value
        exact, query = sequence(inner)
        if exact is not None and least == most and len(exact) ** least <= MOST_STRINGS:
            return {"".join(x) for x in product(exact, repeat=least)}, ALWAYS
        if exact is not None and least == 0 and most == 1:
            return exact | {""}, ALWAYS
        if least == 0:
            return None, ALWAYS
        return None, query if exact is None else from_strings(exact)
    return None, ALWAYS  # anything else is taken to match anything
