"""Report texts to a table."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import tablebind as tb
from tablebind.catalog.tables import texts
from tablebind.plans.checkpoints import new_folder
from tablebind.sources.tables import CSV_OPTIONS

RULE_SCHEMA = "Pattern string, Extract string, Fld string"

PAGE_RULES = [
    (r'.*?<html[^>]*lang="([^"]*)".*', r"\1", "lang"),
    (r'.*?<meta charset="([^"]*)".*', r"\1", "charset"),
    (r".*?<title>(.*?)</title>.*", r"\1", "title"),
    (r'.*?<a href="([^"]*)">([^<]*)</a>.*', r"\2 -> \1", "first_link"),
    (r"<h1[^>]*>(.*?)</h1>", r"[\1]", "marked_heading"),
    (r".*?<blink>(.*?)</blink>.*", r"\1", "blink"),
]

LINE_RULES = [
    (r".+The\s+(\S*).*", r"\1", "after_the"),
    (r".+?\n*Is\s+(\S*).*", r"\1", "after_is"),
    (r".+?An", r"", "an"),
    (r"^Le .*", r"", "start"),
    (r"\d\.", r"#", "number"),
]


def split_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with blank lines and form feeds between sentences."""
    text = F.replace(F.col("text"), F.lit(". "), F.lit(".\n\n"))
    text = F.replace(text, F.lit(", "), F.lit(",\f\f"))
    text = F.concat(F.lit("\n  "), text, F.lit("\r\n\r\n"))
    return texts(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", text.alias("text"))


SPLIT_TEXT = r"""
SELECT doc_id, chr(10) || '  ' ||
       replace(replace(text, '. ', '.' || chr(10) || chr(10)), ', ', ',' || chr(12) || chr(12))
       || chr(13) || chr(10) || chr(13) || chr(10) AS text
FROM documents
"""


def _normalized_sql(text: str) -> str:
    return (
        rf"regexp_replace(trim(regexp_replace(regexp_replace({text}, '\r\n?', chr(10), 'g'), "
        r"'\n{2,}', chr(10), 'g'), chr(10)), '\n{2,}|\f+', chr(10), 'g')"
    )


def _heads_sql(source: str) -> str:
    return rf"""
SELECT DISTINCT regexp_replace(line,
         '^([^\t\n\f\r\p{{Z}}]+?)[\t\n\f\r\p{{Z}}].+$', '\1') AS head
FROM (SELECT unnest(string_split(
        regexp_replace({_normalized_sql("text")}, '^[\t\n\f\r\p{{Z}}]+', ''), chr(10))) AS line
      FROM {source})
"""


def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tb.normalize_text(split_text(spark, sf_dir))


def extract_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(PAGE_RULES, RULE_SCHEMA)
    return tb.extract_fields(texts(spark, sf_dir, "pages", "page_id", "html"), rules, "html", ["page_id"])


def _field_sql(text: str, pattern: str, extract: str, name: str) -> str:
    return (
        f"CASE WHEN regexp_matches({text}, '{pattern}', 's') "
        f"THEN regexp_replace({text}, '{pattern}', '{extract}', 's') END AS {name}"
    )


PAGE_FIELDS = ", ".join(_field_sql("html", *rule) for rule in PAGE_RULES)
LINE_FIELDS = ", ".join(_field_sql("text", *rule) for rule in LINE_RULES)


def documents_to_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(LINE_RULES, RULE_SCHEMA)
    return tb.documents_to_table(split_text(spark, sf_dir), rules).data


def line_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tb.line_heads(split_text(spark, sf_dir))


def unmatched_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(LINE_RULES, RULE_SCHEMA)
    return tb.documents_to_table(texts(spark, sf_dir, "documents", "doc_id", "text"), rules).unmatched


def write_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The unmatched headings, written as csv and read again."""
    folder = new_folder(spark, "heads")
    tb.write_heads(unmatched_heads(spark, sf_dir), folder)
    return spark.read.options(**CSV_OPTIONS).schema("head string").csv(folder)


#: Rules for what headings open with, hold or end with, each for a few letters only.
LETTERS = "abcdefghijklmnopqrstuvwxyz"
MANY_RULES = (
    [(f".+{(a + b).capitalize()}.*", "", a + b) for a in LETTERS for b in LETTERS[13:]]
    + [(f"{a}{b}{c}$", "", a + b + c) for a in LETTERS[:8] for b in LETTERS[4:12] for c in LETTERS[::5]]
    + [("[0-9]{2}", "", "digits"), ("(Th|Ti)[aeiou]s", "", "choice")]
)


def unmatched_heads_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The headings that none of a thousand rules knows."""
    rules = spark.createDataFrame(MANY_RULES, RULE_SCHEMA)
    return tb.unmatched_heads(texts(spark, sf_dir, "documents", "doc_id", "text"), rules)


def document_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The headings of text files read line by line: documents by source, one below the other."""
    folder = new_folder(spark, "lines")
    docs = split_text(spark, sf_dir).where("text IS NOT NULL")
    docs = docs.withColumn("run", F.floor(F.col("doc_id") / DOCS_OF_A_FILE))
    ordered = docs.repartition("run").sortWithinPartitions("run", "doc_id").select("run", "text")
    ordered.write.partitionBy("run").text(folder, lineSep="\n\n")
    return tb.document_heads(tb.read_lines(spark, folder))


#: Documents in one text file.
DOCS_OF_A_FILE = 500

QUERIES = {
    "document_heads": document_heads,
    "unmatched_heads_many": unmatched_heads_many,
    "write_heads": write_heads,
    "normalize_text": normalize_text,
    "extract_fields": extract_fields,
    "documents_to_table": documents_to_table,
    "line_heads": line_heads,
    "unmatched_heads": unmatched_heads,
}

UNMATCHED = rf"""
SELECT head FROM ({_heads_sql("documents")})
WHERE NOT regexp_matches(head, '^The\s+(\S*).*', 's')
  AND NOT regexp_matches(head, '^Is\s+(\S*).*', 's')
  AND NOT regexp_matches(head, '^An', 's')
  AND NOT regexp_matches(head, '\d\.', 's')
"""

UNMATCHED_MANY = rf"""
SELECT head FROM ({_heads_sql("documents")})
WHERE NOT regexp_matches(head, '^[A-Z][n-z]')
  AND NOT regexp_matches(head, '[a-h][e-l][afkpuz]$')
  AND NOT regexp_matches(head, '[0-9]{{2}}|(Th|Ti)[aeiou]s')
"""

#: Lines of whole files, so only the first text of each is trimmed at its start.
DOCUMENT_HEADS = rf"""
WITH files AS (
  SELECT string_agg(text, chr(10) || chr(10) ORDER BY doc_id) AS text FROM ({SPLIT_TEXT})
  WHERE text IS NOT NULL GROUP BY doc_id // {DOCS_OF_A_FILE})
{_heads_sql("files")}
"""

ORACLES = {
    "document_heads": DOCUMENT_HEADS,
    "unmatched_heads_many": UNMATCHED_MANY,
    "normalize_text": f"SELECT doc_id, {_normalized_sql('text')} AS text FROM ({SPLIT_TEXT})",
    "extract_fields": f"SELECT page_id, {PAGE_FIELDS} FROM pages",
    "documents_to_table": f"SELECT doc_id, {LINE_FIELDS} FROM "
    f"(SELECT doc_id, {_normalized_sql('text')} AS text FROM ({SPLIT_TEXT}))",
    "line_heads": _heads_sql(f"({SPLIT_TEXT})"),
    "unmatched_heads": UNMATCHED,
    "write_heads": UNMATCHED,
}
