"""Regular expressions the reports were written for, in Java's dialect."""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The dot of a rule also matches a line break.
DOT_ALL = "(?s)"

# An opening any-text part, bare or as a group of its own that no quantifier follows.
OPEN_START = re.compile(r"\.[+*]\??(?![+*?{])|\((?:\?:)?\.[+*]\??\)(?![+*?{])")

_HEAD = "tbhead"
_TAIL = "tbtail"


def _shifted(pattern: str, by: int) -> str:
    """Renumber the back references of a pattern that gets ``by`` groups in front."""

    def renumber(found: re.Match) -> str:
        number = found.group(1)
        return f"\\{int(number) + by}" if number else found.group(0)

    return re.sub(r"\\(?:([1-9])|.)", renumber, pattern, flags=re.DOTALL)


def _replacement(extract: str, by: int) -> str:
    r"""Java replacement text for one that names groups ``\1`` to ``\9`` (``\0``: all)."""

    def piece(found: re.Match) -> str:
        number, char = found.group(1), found.group(2) or found.group(3)
        if number:
            return f"${int(number) + by}"
        # Every literal is escaped, so a digit after a group number stays a digit.
        return "\\" + char

    return re.sub(r"\\([0-9])|\\(.)|(.)", piece, extract, flags=re.DOTALL)


def _has_alternatives(pattern: str) -> bool:
    """Whether a bar stands outside all groups and character classes."""
    depth, in_class, i = 0, False, 0
    while i < len(pattern):
        char = pattern[i]
        if char == "\\":
            i += 1
        elif in_class:
            in_class = char != "]"
        elif char == "[":
            in_class = True
        elif char in "()":
            depth += 1 if char == "(" else -1
        elif char == "|" and depth == 0:
            return True
        i += 1
    return False


def starts_at_start(pattern: str) -> bool:
    """Whether a match, if there is any, begins where the text begins.

    True when the pattern opens with an any-text part: the dot matches all characters,
    so that part can always reach back. Searching at later places would only repeat the
    failure, in time quadratic in the text.
    """
    return bool(OPEN_START.match(pattern)) and not _has_alternatives(pattern)


def literal_runs(pattern: str) -> list[tuple[int, str]]:
    """The literal texts that every match has, with their places in the pattern, in order.

    Groups, classes and what a quantifier makes optional are passed over; a pattern with
    alternatives, flags or quoted parts has none.
    """
    if _has_alternatives(pattern) or "\\Q" in pattern or re.search(r"\(\?[a-zA-Z-]+[):]", pattern):
        return []
    runs: list[tuple[int, str]] = []
    run, start, i = "", 0, 0

    def end() -> None:
        nonlocal run
        if run:
            runs.append((start, run))
        run = ""

    while i < len(pattern):
        char, width = pattern[i], 1
        literal = char not in ".[](){}*+?|^$\\"
        if char == "\\":
            char, width = pattern[i + 1 : i + 2], 2
            literal = char.isascii() and not char.isalnum() and char != ""
        elif char in "[(":
            width = _bracket(pattern, i)
        after = pattern[i + width : i + width + 1]
        if literal and after not in ("*", "?", "{"):
            start = start if run else i
            run += char
            if after == "+":
                end()
        else:
            end()
        i += width
        if after and after in "*+?":
            i += 1
        elif after == "{":
            i = max(pattern.find("}", i) + 1, i + 1)
    end()
    return runs


def _bracket(pattern: str, at: int) -> int:
    """The length of the group or class that opens at ``at``."""
    depth, in_class, i = 0, False, at
    while i < len(pattern):
        char = pattern[i]
        if char == "\\":
            i += 1
        elif in_class:
            in_class = char != "]"
        elif char == "[":
            in_class = True
        elif char in "()":
            depth += 1 if char == "(" else -1
        if not in_class and depth == 0:
            return i + 1 - at
        i += 1
    return len(pattern) - at


def opening_text(pattern: str) -> tuple[bool, str]:
    """The literal text that every match begins with, and whether it stands at the text's start."""
    at_start = pattern.startswith("^")
    place, text = next(iter(literal_runs(pattern)), (-1, ""))
    return (at_start, text) if place == int(at_start) else (False, "")


def replace_first(text: Column, pattern: str, extract: str) -> Column:
    """``text`` with its first match of ``pattern`` replaced; the rest stays.

    The built-in replacement takes every match, so the expression matches the whole text
    around one: what lies before (as little as possible), the match, what lies after.
    """
    before = "" if starts_at_start(pattern) else ".*?"
    whole = f"{DOT_ALL}\\A(?<{_HEAD}>{before})({_shifted(pattern, 2)})(?<{_TAIL}>.*)\\z"
    return F.regexp_replace(text, whole, f"${{{_HEAD}}}{_replacement(extract, 2)}${{{_TAIL}}}")


def contains(text: Column, pattern: str) -> Column:
    """Whether ``pattern`` occurs in ``text``.

    The longest text that every match has is looked for first, so a pattern that does not occur
    costs a plain search.
    """
    start = "\\A" if starts_at_start(pattern) else ""
    found = text.rlike(DOT_ALL + start + pattern)
    needed = max((t for _, t in literal_runs(pattern)), key=len, default="")
    return F.contains(text, F.lit(needed)) & found if needed else found
