"""Boolean trigram queries that a text must meet to match a regular expression."""

import re._constants as kinds
import re._parser as parser
from itertools import product

#: Strings followed side by side, and characters of a class that are spelled out.
MOST_STRINGS, MOST_CHARACTERS = 16, 6

Clauses = list[frozenset[str]]
ALWAYS: Clauses = [frozenset()]


def _trigrams(strings: set[str]) -> Clauses:
    """One clause for each string, all of whose trigrams are needed."""
    return [frozenset(s[k : k + 3] for k in range(len(s) - 2)) for s in strings]


def _both(a: Clauses, b: Clauses) -> Clauses:
    return _least([x | y for x, y in product(a, b)])


def _least(clauses: Clauses) -> Clauses:
    """Without clauses that another one implies."""
    distinct = sorted(set(clauses), key=lambda c: (len(c), sorted(c)))
    return [c for k, c in enumerate(distinct) if not any(d <= c for d in distinct[:k])]


def _members(items) -> set[str] | None:
    """The characters of a class, if they are few."""
    found: set[str] = set()
    for kind, value in items:
        if kind is kinds.LITERAL:
            found.add(chr(value).lower())
        elif kind is kinds.RANGE and value[1] - value[0] < MOST_CHARACTERS:
            found |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return found if len(found) <= MOST_CHARACTERS else None


def _strings(kind, value) -> set[str] | None:
    """All strings a part can match, if they are few."""
    if kind is kinds.LITERAL:
        return {chr(value).lower()}
    if kind is kinds.IN:
        return _members(value)
    if kind is kinds.SUBPATTERN:
        return _all_strings(value[3])
    if kind is kinds.BRANCH:
        parts = [_all_strings(x) for x in value[1]]
        return None if None in parts else set().union(*parts)
    if kind is kinds.AT:
        return {""}
    if kind in (kinds.MAX_REPEAT, kinds.MIN_REPEAT) and value[1] != kinds.MAXREPEAT and value[1] <= 2:
        inner = _all_strings(value[2])
        if inner is not None:
            times = range(value[0], value[1] + 1)
            return {"".join(x) for n in times for x in product(inner, repeat=n)}
    return None


def _all_strings(sequence) -> set[str] | None:
    found = {""}
    for kind, value in sequence:
        part = _strings(kind, value)
        if part is None or len(part) * len(found) > MOST_STRINGS:
            return None
        found = {a + b for a, b in product(found, part)}
    return found


def _needed(sequence) -> Clauses:
    """Follows the exact strings of a sequence; what is not exact ends them."""
    need, exact = ALWAYS, {""}
    for kind, value in sequence:
        part = _strings(kind, value)
        if part is not None and len(part) * len(exact) <= MOST_STRINGS:
            exact = {a + b for a, b in product(exact, part)}
            continue
        need, exact = _both(need, _trigrams(exact)), {""}
        if part is not None:
            exact = part
        elif kind is kinds.SUBPATTERN:
            need = _both(need, _needed(value[3]))
        elif kind is kinds.BRANCH:
            need = _both(need, _least([c for x in value[1] for c in _needed(x)]))
        elif kind in (kinds.MAX_REPEAT, kinds.MIN_REPEAT) and value[0] > 0:
            need = _both(need, _needed(value[2]))
    return _both(need, _trigrams(exact))


def trigram_query(pattern: str) -> Clauses | None:
    """Sets of lower-case trigrams: a match holds all of at least one set, in either case of
    letters. None if no trigram is mandatory."""
    clauses = _needed(parser.parse(pattern))
    return None if any(not c for c in clauses) else clauses
