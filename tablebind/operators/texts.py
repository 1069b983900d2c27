"""Report texts to one table, by rules."""

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablebind.functions.regex import DOT_ALL, contains, opening_text, replace_first
from tablebind.plans.checkpoints import checkpointed
from tablebind.plans.joins import lookup
from tablebind.sources.dictionaries import Rule, load_rules

# The blanks a heading ends at, a line with its heading, what precedes the
# text part of a rule, and the openings that stand for the start of a line.
BLANK = r"[\t\n\f\r\p{Z}]"
HEADED_LINE = r"^([^\t\n\f\r\p{Z}]+?)[\t\n\f\r\p{Z}].+$"
RULE_PREFIX = r"^[^医]*医生(.+)$"
RULE_OPENING = r"^\.\+\?*(?:\\n)*"

# Rules that are all tried on every heading; more are found by what they open with, by so many
# of its characters at the start of a heading, or anywhere in it.
TRIED_RULES = 32
START_CHARS, INNER_CHARS = 8, 4


def normalized(text: Column, left_trim: bool = False) -> Column:
    """The text without blank lines; form feeds are line breaks."""
    lines = F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    lines = F.trim(F.regexp_replace(lines, r"\n{2,}", "\n"), F.lit("\n"))
    lines = F.regexp_replace(lines, r"\f+", "\n")
    return F.regexp_replace(lines, f"^{BLANK}+", "") if left_trim else lines


def normalize_text(df: DataFrame, column: str = "text", left_trim: bool = False) -> DataFrame:
    """Drop blank lines, turn runs of breaks and form feeds into one break."""
    return df.withColumn(column, normalized(F.col(column), left_trim))


def _as_rules(rules: DataFrame | Sequence[Rule]) -> list[Rule]:
    return load_rules(rules) if isinstance(rules, DataFrame) else list(rules)


def field_names(rules: Sequence[Rule]) -> list[str]:
    """One name per rule; a field with several rules gets numbered names."""
    seen: dict[str, int] = {}
    names = []
    for rule in rules:
        times = seen[rule.field.lower()] = seen.get(rule.field.lower(), 0) + 1
        names.append(rule.field if times == 1 else f"{rule.field}_{times}")
    return names


def extract_fields(
    df: DataFrame,
    rules: DataFrame | Sequence[Rule],
    column: str = "text",
    keep: Sequence[str] = ("doc_id",),
) -> DataFrame:
    r"""One row per text, one column per rule (``Pattern``, ``Extract``, ``Fld``).

    A field is the text with the first match of the pattern replaced by the extract, which
    may name groups as ``\1``; it is null when the pattern does not occur.
    """
    rules = _as_rules(rules)
    text = F.col(column)
    fields = [
        F.when(contains(text, r.pattern), replace_first(text, r.pattern, r.extract)).alias(name)
        for r, name in zip(rules, field_names(rules))
    ]
    return df.select(*keep, *fields)


def line_heads(df: DataFrame, column: str = "text") -> DataFrame:
    """The distinct line headings of all texts.

    A heading is what precedes the first blank of a line, or the whole line.
    """
    line = F.explode(F.split(normalized(F.col(column), left_trim=True), "\n"))
    heads = df.select(line.alias("line"))
    return heads.select(F.regexp_replace("line", HEADED_LINE, "$1").alias("head")).distinct()


def document_heads(lines: DataFrame) -> DataFrame:
    """The distinct line headings of documents read line by line; see ``read_lines``.

    The same as ``line_heads`` of the whole texts, for documents of any length: nothing but the
    place of each document's first text is gathered, and that is combined before it is shuffled.
    Documents without any text have no heading.
    """
    text = normalized(F.col("text"))
    pieces = lines.where(text != "").select("path", "block", "at", F.posexplode(F.split(text, "\n")).alias("n", "line"))
    place = F.struct("block", "at", "n")
    begun = F.col("line").rlike("[^\t\n\f\r\\p{Z}]")
    first = checkpointed(pieces.where(begun).groupBy("path").agg(F.min(place).alias("first")))
    # What is blank at a text's start is trimmed, over lines as well.
    kept = lookup(pieces, first, ["path"], "inner").where(place >= F.col("first"))
    line = F.when(place == F.col("first"), F.regexp_replace("line", f"^{BLANK}+", "")).otherwise(F.col("line"))
    return kept.select(F.regexp_replace(line, HEADED_LINE, "$1").alias("head")).distinct()


def head_patterns(rules: Sequence[Rule]) -> list[str]:
    """The headings the rules know, as patterns."""
    cut = [re.sub(RULE_PREFIX, r"\1", r.pattern, count=1) for r in rules]
    starts = [re.sub(RULE_OPENING, "^", p) for p in cut if not p.startswith("^")]
    return list(dict.fromkeys(starts))


def unmatched_heads(
    df: DataFrame, rules: DataFrame | Sequence[Rule], column: str = "text"
) -> DataFrame:
    """Distinct headings that no rule knows. Patterns run once per distinct heading.

    Of many rules, a heading is tried against those only whose opening text it has: it meets an
    index of openings by equality, so time follows the candidates. Rules without an opening text
    are tried on all headings.
    """
    return unknown_heads(line_heads(df, column), rules)


def unknown_heads(heads: DataFrame, rules: DataFrame | Sequence[Rule]) -> DataFrame:
    """Of distinct headings (``head``) those that no rule knows; see ``unmatched_heads``."""
    patterns = head_patterns(_as_rules(rules))
    index: dict[tuple[bool, str], list[str]] = {}
    if len(patterns) > TRIED_RULES:
        for pattern in patterns:
            at_start, text = opening_text(pattern)
            if text and len(text.encode("utf-16-le")) == 2 * len(text):
                key = text[: START_CHARS if at_start else INNER_CHARS]
                index.setdefault((at_start, key), []).append(pattern)
    indexed = {p for held in index.values() for p in held}
    # One flat choice: thousands of rules nest no deeper than one.
    unknown = F.when(F.lit(False), False)
    for pattern in patterns:
        if pattern not in indexed:
            unknown = unknown.when(contains(F.col("head"), pattern), False)
    heads = heads.where(unknown.otherwise(True))
    return _not_in(heads, index) if index else heads


def _not_in(heads: DataFrame, index: dict[tuple[bool, str], list[str]]) -> DataFrame:
    """Headings (distinct) that none of the patterns matches, by their opening texts."""
    head, length = F.col("head"), F.length("head")
    rows = [(at_start, key, [DOT_ALL + p for p in held]) for (at_start, key), held in index.items()]
    known = checkpointed(
        heads.sparkSession.createDataFrame(rows, "at_start boolean, key string, patterns array<string>")
    )

    def texts(at_start: bool, n: int) -> Column:
        """The texts of n characters that patterns may open with."""
        if at_start:
            return F.array(F.substring(head, 1, n))
        places = F.sequence(F.lit(1), F.greatest(length - n + 1, F.lit(1)))
        return F.array_distinct(F.transform(places, lambda i: F.substring(head, i, F.lit(n))))

    def keyed(at_start: bool, n: int) -> Column:
        return F.transform(
            texts(at_start, n), lambda x: F.struct(F.lit(at_start).alias("at_start"), x.alias("key"))
        )

    keys = [keyed(*kind) for kind in sorted({(at_start, len(key)) for at_start, key in index})]
    each = heads.select("head", F.explode(F.concat(*keys)).alias("k")).select("head", "k.at_start", "k.key")
    tried = lookup(each, known, ["at_start", "key"], "left")
    matches = F.exists("patterns", lambda p: F.regexp_like(head, p))
    # Headings are distinct and stay where they are, so this is no second shuffle.
    found = tried.groupBy("head").agg(F.max(F.coalesce(matches, F.lit(False))).alias("known"))
    return found.where("NOT known").select("head")


@dataclass(frozen=True)
class DocumentTable:
    data: DataFrame
    unmatched: DataFrame


def documents_to_table(
    docs: DataFrame, rules: DataFrame | Sequence[Rule], column: str = "text"
) -> DocumentTable:
    """Texts to a table of fields, and the headings the rules do not know."""
    rules = _as_rules(rules)
    keep = [c for c in docs.columns if c != column]
    data = extract_fields(normalize_text(docs, column), rules, column, keep)
    return DocumentTable(data, unmatched_heads(docs, rules, column))
