"""Shortened summaries."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import tablebind as tb
from tablebind.catalog.tables import texts
from tablebind.operators.summaries import shorten_clause, split_clauses

# Documents stand in for summaries: a capital letter begins a clause.
BEGINNER = "[A-Z][a-z]+ "
SPECIAL = "the |de la "


def simplify_clauses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clause steps alone, one row per clause."""
    clauses = split_clauses(F.col("text"), BEGINNER)
    short = F.transform(clauses, lambda c: shorten_clause(c, ".,", SPECIAL))
    return texts(spark, sf_dir, "documents", "doc_id", "text").select(
        "doc_id", F.posexplode(short).alias("at", "clause")
    )


def numbered(text: Column) -> Column:
    """Prose in the manner of numbered findings."""
    text = F.regexp_replace(text, r"\. ([A-Z])", "。 12.$1")
    text = F.regexp_replace(text, ", ([a-f])", " (3)$1")
    return F.concat(text, F.lit(" 4.家族史提示:父亲"))


def bracketed(text: Column) -> Column:
    """Prose in the manner of bracketed findings."""
    text = F.regexp_replace(text, r"\. ([A-Z][a-z]*)", "。\r\n【$1】偏高：")
    return F.replace(text, F.lit(", "), F.lit("："))


def framed(text: Column) -> Column:
    """Prose between a salutation and explanations, with advice and asides."""
    text = F.replace(text, F.lit(", "), F.lit("，建议"))
    text = F.regexp_replace(text, r"\. ([A-M])", ".\n  （注）$1")
    text = F.regexp_replace(text, r"\. ([N-Z])", ".\r\n12、$1")
    text = F.replace(text, F.lit(" d"), F.lit("\n  提示d\n d"))
    return F.concat(F.lit("尊敬的张三★你好★"), text, F.lit("\n体检结果说明：\n完\n"))


NUMBERED = r"""
regexp_replace(regexp_replace(text, '\. ([A-Z])', '。 12.\1', 'g'), ', ([a-f])', ' (3)\1', 'g')
|| ' 4.家族史提示:父亲'
"""
BRACKETED = r"""
replace(regexp_replace(text, '\. ([A-Z][a-z]*)',
  '。' || chr(13) || chr(10) || '【\1】偏高：', 'g'), ', ', '：')
"""
FRAMED = r"""
'尊敬的张三★你好★' || replace(regexp_replace(regexp_replace(replace(text, ', ', '，建议'),
  '\. ([A-M])', '.' || chr(10) || '  （注）\1', 'g'),
  '\. ([N-Z])', '.' || chr(13) || chr(10) || '12、\1', 'g'),
  ' d', chr(10) || '  提示d' || chr(10) || ' d') || chr(10) || '体检结果说明：' || chr(10) || '完'
  || chr(10)
"""


def _prepared(spark: SparkSession, sf_dir: str, text: Column) -> DataFrame:
    return texts(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", text.alias("text"))


def simplify_ciming(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _prepared(spark, sf_dir, numbered(F.col("text")))
    return tb.simplify_summary(df, "text", "Ciming").select("doc_id", "summ")


def simplify_ciming_overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    talk = texts(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    short = tb.simplify_summary(
        talk, "D", "Ciming", beginner=BEGINNER, ender=".,", special=SPECIAL
    )
    return short.select("conv_id", "turn", "role", "summ")


def simplify_ikang(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _prepared(spark, sf_dir, bracketed(F.col("text")))
    return tb.simplify_summary(df, "text", "Ikang").select("doc_id", "summ")


def simplify_meinian(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _prepared(spark, sf_dir, framed(F.col("text")))
    return tb.simplify_summary(df, "text", "Meinian").select("doc_id", "summ")


def simplify_by_provider(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each text in the manner of a provider of its own; some providers are unknown."""
    text, kind = F.col("text"), F.col("doc_id") % 4
    df = texts(spark, sf_dir, "documents", "doc_id", "text").select(
        "doc_id",
        F.when(kind == 0, "Ciming").when(kind == 1, "Ikang").when(kind == 2, "Meinian")
        .otherwise("other").alias("provider"),
        F.when(kind == 0, numbered(text)).when(kind == 1, bracketed(text))
        .otherwise(framed(text)).alias("text"),
    )
    short = tb.simplify_summary(df, "text", provider_column="provider")
    return short.select("doc_id", "provider", "summ")


SPACE = r"[\s\x0B\x{85}\p{Z}]"
JOINER = r"'\r\n'"


def _clauses_sql(text: str, beginner: str) -> str:
    marked = f"regexp_replace({text}, '{SPACE}*({beginner})', chr(10) || '\\1', 'g')"
    lines = f"regexp_replace(replace({marked}, chr(13), chr(10)), '\\n{{2,}}', chr(10), 'g')"
    return f"string_split({lines}, chr(10))"


def _short_sql(ender: str, special: str | None) -> str:
    to_ender = (
        f"CASE WHEN regexp_matches(c, '[{ender}]') THEN regexp_extract(c, '^[^{ender}]+?[{ender}]') "
        "ELSE c END"
    )
    if special is None:
        return to_ender
    return (
        f"CASE WHEN regexp_matches(c, '{special}') THEN regexp_extract(c, '^.+?({special})') "
        f"ELSE {to_ender} END"
    )


def _ends_sql(text: str, last: str) -> str:
    return (
        f"regexp_replace({text}, '^{SPACE}+|{SPACE}*(\\d+\\.){SPACE}*|^\\\\r\\\\n|\\\\r$|\\\\n$"
        f"{last}', '\\1', 'g')"
    )


def _finished_sql(joined: str) -> str:
    return _ends_sql(
        f"regexp_replace({joined}, '(\\\\r\\\\n){{2,}}', chr(13) || chr(10), 'g')",
        "|\\\\r\\\\n$",
    )


def _ciming_sql(text: str, beginner: str, ender: str, special: str) -> str:
    clauses = _clauses_sql(text, beginner)
    joined = (
        f"array_to_string(list_transform({clauses}, lambda c: {_short_sql(ender, special)}), {JOINER})"
    )
    return _ends_sql(f"regexp_replace({joined}, '\\d\\.家族史提示.+$', '', 'g')", "")


def _ikang_sql(text: str) -> str:
    clauses = _clauses_sql(text, "【")
    return _finished_sql(
        f"array_to_string(list_transform(list_filter({clauses}, lambda c: contains(c, '【')), "
        f"lambda c: {_short_sql('：:', None)}), {JOINER})"
    )


def _meinian_sql(text: str) -> str:
    cut = f"regexp_replace({text}, '尊敬的.+?(★)|体检结果说明.+$', '\\1', 'gs')"
    lines = (
        f"list_transform(string_split(replace({cut}, chr(13), chr(10)), chr(10)), "
        f"lambda s: regexp_replace(s, '^{SPACE}+|{SPACE}+$', '', 'g'))"
    )
    advice = (
        "建议.+$|请.+$|注意.+$|甲状腺囊肿是.+$|慢性鼻炎是.+$|肾结晶多为.+$|瓣膜返流多见.+$|痛风依病因.+$"
    )
    findings = (
        f"list_transform({lines}, lambda s: "
        f"CASE WHEN regexp_matches(s, '^\\d+、.+|^[（()]|^请|^如|^提示') THEN '' "
        f"ELSE regexp_replace(s, '{advice}', '') END)"
    )
    return _finished_sql(f"array_to_string(list_filter({findings}, lambda s: s <> ''), {JOINER})")


CIMING = _ciming_sql(
    f"({NUMBERED})", r"\d+\.\D|\(\d+\)\D", "。？", "矫正视力不足|您的体重.+?范围"
)
IKANG = _ikang_sql(f"({BRACKETED})")
MEINIAN = _meinian_sql(f"({FRAMED})")

SIMPLIFY_CLAUSES = f"""
SELECT doc_id, CAST(generate_subscripts(parts, 1) - 1 AS INTEGER) AS at, unnest(parts) AS clause
FROM (SELECT doc_id,
        list_transform({_clauses_sql("text", BEGINNER)},
                       lambda c: {_short_sql(".,", SPECIAL)}) AS parts
      FROM documents)
"""

BY_PROVIDER = f"""
SELECT doc_id,
       CASE doc_id % 4 WHEN 0 THEN 'Ciming' WHEN 1 THEN 'Ikang' WHEN 2 THEN 'Meinian'
                       ELSE 'other' END AS provider,
       CASE doc_id % 4 WHEN 0 THEN {CIMING} WHEN 1 THEN {IKANG} WHEN 2 THEN {MEINIAN} END AS summ
FROM documents
"""

QUERIES = {
    "simplify_clauses": simplify_clauses,
    "simplify_ciming": simplify_ciming,
    "simplify_ciming_overrides": simplify_ciming_overrides,
    "simplify_ikang": simplify_ikang,
    "simplify_meinian": simplify_meinian,
    "simplify_by_provider": simplify_by_provider,
}

ORACLES = {
    "simplify_clauses": SIMPLIFY_CLAUSES,
    "simplify_ciming": f"SELECT doc_id, {CIMING} AS summ FROM documents",
    "simplify_ciming_overrides": "SELECT conv_id, turn, role, "
    f"{_ciming_sql('text', BEGINNER, '.,', SPECIAL)} AS summ FROM conversations",
    "simplify_ikang": f"SELECT doc_id, {IKANG} AS summ FROM documents",
    "simplify_meinian": f"SELECT doc_id, {MEINIAN} AS summ FROM documents",
    "simplify_by_provider": BY_PROVIDER,
}
