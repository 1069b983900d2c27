"""Shorten narrative summaries, in the manner of the provider that wrote them."""

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablebind.functions.names import col

# Fixed values. The joiner and the trimmed ends are the visible characters \ r \ n.
JOINER = r"\r\n"
BROKEN_LINE = "\r\n"

# Stands for the joiner's characters where the text itself has them.
KEPT = "\ue000\ue001"

CIMING_BEGINNER = r"\d+\.\D|\(\d+\)\D"
CIMING_ENDER = "。？"
CIMING_SPECIAL = "矫正视力不足|您的体重.+?范围"
CIMING_TAIL = r"\d\.家族史提示.+$"
CIMING_ENDS = r"^\s+|\s*(\d+\.)\s*|^\\r\\n|\\r$|\\n$"

IKANG_BEGINNER = "【"
IKANG_ENDER = "：:"

MEINIAN_FRAME = "尊敬的.+?(★)|体检结果说明.+$"
MEINIAN_ASIDES = r"^\d+、.+|^[（()]|^请|^如|^提示"
MEINIAN_ADVICE = (
    "建议.+$|请.+$|注意.+$|"
    "甲状腺囊肿是.+$|"
    "慢性鼻炎是.+$|肾结晶多为.+$|"
    "瓣膜返流多见.+$|痛风依病因.+$"
)

REPEATED_JOINERS = r"(\\r\\n){2,}"
ENDS = r"^\s+|\s*(\d+\.)\s*|^\\r\\n|\\r$|\\n$|\\r\\n$"

# Digits and blanks of every script, as the patterns were meant.
UNICODE = "(?U)"


def _characters(ender: str) -> str:
    """The inside of a character class; ``ender`` is plain characters, or such a class."""
    if len(ender) > 2 and ender[0] == "[" and ender[-1] == "]":
        return ender[1:-1]
    return re.sub(r"([\[\]\\^&-])", r"\\\1", ender)


def split_clauses(text: Column, beginner: str) -> Column:
    """Lines of the text, with a new line before each ``beginner``."""
    marked = F.regexp_replace(text, f"{UNICODE}\\s*({beginner})", "\n$1")
    return F.split(marked, "[\r\n]+")


def shorten_clause(clause: Column, ender: str, special: str | None = None) -> Column:
    """The clause up to its special text, else up to its first ender, else as it is.

    A clause with nothing before that place is empty.
    """
    end = _characters(ender)
    short = F.regexp_extract(clause, f"^[^{end}]++(?:[{end}]|\\z)", 0)
    if not special:
        return short
    to_special = F.regexp_extract(clause, f"{UNICODE}^.+?(?:{special})", 0)
    return F.when(clause.rlike(UNICODE + special), to_special).otherwise(short)


def simplify_ciming(
    text: Column,
    beginner: str | None = None,
    ender: str | None = None,
    special: str | None = None,
) -> Column:
    """Numbered findings: keep each up to its first full stop; drop the family history.

    ``special=""`` switches the special texts off.
    """
    ender = ender or CIMING_ENDER
    special = CIMING_SPECIAL if special is None else special
    clauses = split_clauses(text, beginner or CIMING_BEGINNER)
    kept = F.transform(clauses, lambda c: shorten_clause(c, ender, special))
    joined = F.regexp_replace(F.array_join(kept, JOINER), UNICODE + CIMING_TAIL, "")
    return F.regexp_replace(joined, UNICODE + CIMING_ENDS, "$1")


def simplify_ikang(
    text: Column,
    beginner: str | None = None,
    ender: str | None = None,
    special: str | None = None,
) -> Column:
    """Bracketed findings: keep each up to its colon, drop lines without a bracket."""
    beginner, ender = beginner or IKANG_BEGINNER, ender or IKANG_ENDER
    clauses = F.filter(split_clauses(text, beginner), lambda c: c.rlike(UNICODE + beginner))
    kept = F.transform(clauses, lambda c: shorten_clause(c, ender, special))
    return _finished(F.array_join(kept, JOINER))


def simplify_meinian(text: Column) -> Column:
    """Findings between salutation and explanations, without asides and advice."""
    framed = F.regexp_replace(text, f"(?s){MEINIAN_FRAME}", "$1")

    def finding(line: Column) -> Column:
        line = F.regexp_replace(line, UNICODE + r"^\s+|\s+$", "")
        plain = F.regexp_replace(line, MEINIAN_ADVICE, "")
        return F.when(~line.rlike(UNICODE + MEINIAN_ASIDES), plain).otherwise("")

    findings = F.filter(F.transform(F.split(framed, "[\r\n]"), finding), lambda s: s != "")
    return _finished(F.array_join(findings, JOINER))


def _finished(joined: Column) -> Column:
    merged = F.regexp_replace(joined, REPEATED_JOINERS, BROKEN_LINE)
    return F.regexp_replace(merged, UNICODE + ENDS, "$1")


PROVIDERS: dict[str, Callable[..., Column]] = {
    "Ciming": simplify_ciming,
    "Meinian": simplify_meinian,
    "Ikang": simplify_ikang,
}


def resolve_column(df: DataFrame, column: str | int) -> str:
    """A column by name, by position from 1, or by spreadsheet letter."""
    if isinstance(column, int):
        return df.columns[column - 1]
    if column in df.columns:
        return column
    if re.fullmatch("[A-Za-z]{1,3}", column):
        place = 0
        for letter in column.upper():
            place = place * 26 + ord(letter) - ord("A") + 1
        if place <= len(df.columns):
            return df.columns[place - 1]
    raise ValueError(f"no such column: {column}")


def simplify_summary(
    df: DataFrame,
    column: str | int,
    provider: str = "Ciming",
    provider_column: str | None = None,
    output: str = "summ",
    joiner: str = JOINER,
    **overrides: str,
) -> DataFrame:
    """Add ``output``, the shortened text of ``column``; a null text gives an empty one.

    The style is that of ``provider``, or per row of ``provider_column`` (null for a name
    that is no provider). ``overrides`` are ``beginner`` (a pattern), ``ender`` (characters)
    and ``special`` (a pattern); Meinian takes none, and a provider column leaves them to
    the others. Another ``joiner`` joins the clauses only; the same characters in the text stay.
    """
    unknown = set(overrides) - {"beginner", "ender", "special"}
    if unknown:
        raise TypeError(f"unknown overrides: {', '.join(sorted(unknown))}")
    name = resolve_column(df, column)
    text = col(name)

    def simplified(style: str) -> Column:
        given = {} if style == "Meinian" else overrides
        if joiner == JOINER:
            return F.coalesce(PROVIDERS[style](text, **given), F.lit(""))
        own = F.replace(text, F.lit(JOINER), F.lit(KEPT))
        short = F.coalesce(PROVIDERS[style](own, **given), F.lit(""))
        short = F.replace(short, F.lit(JOINER), F.lit(joiner))
        return F.replace(short, F.lit(KEPT), F.lit(JOINER))

    if provider_column is None:
        if provider not in PROVIDERS:
            raise ValueError(f"provider is one of {', '.join(PROVIDERS)}")
        if provider == "Meinian" and overrides:
            raise TypeError("Meinian takes no overrides")
        return df.withColumn(output, simplified(provider))
    chosen = F.lit(None).cast("string")
    for style in PROVIDERS:
        chosen = F.when(F.col(provider_column) == style, simplified(style)).otherwise(chosen)
    return df.withColumn(output, chosen)
