"""Header rows of raw sheets."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import tablebind as tb
from tablebind.catalog.rows import VALUE_IS_NUMERIC
from tablebind.catalog.tables import texts


def document_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as sheets: a line is a row, a word is a cell."""
    lines = texts(spark, sf_dir, "documents", "doc_id", "source", "text").select(
        F.col("source").alias("FILE"),
        F.col("doc_id").cast("string").alias("SHEET"),
        F.posexplode(F.split("text", "\n")).alias("at", "line"),
    )
    words = lines.select(
        "FILE", "SHEET", (F.col("at") + 1).alias("row"), F.posexplode(F.split("line", " "))
    )
    return words.select(
        "FILE", "SHEET", "row", (F.col("pos") + 1).alias("col"), F.col("col").alias("value")
    )


CELLS = """
lines AS (
  SELECT source AS FILE, CAST(doc_id AS VARCHAR) AS SHEET,
         unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS row
  FROM documents),
cells AS (
  SELECT FILE, SHEET, row, unnest(string_split(line, ' ')) AS value,
         generate_subscripts(string_split(line, ' '), 1) AS col
  FROM lines)
"""

IS_FILLED = "value NOT IN ('', 'NA')"
IS_NAME = f"{IS_FILLED} AND NOT {VALUE_IS_NUMERIC} AND length(value) < 64"

PROFILE = f"""
{CELLS},
width AS (SELECT FILE, SHEET, max(col) AS width FROM cells GROUP BY ALL),
profile AS (
  SELECT c.FILE, c.SHEET, CAST(c.row AS INTEGER) AS "RowNum",
         count(*) FILTER ({IS_NAME}) / any_value(width) AS "Valid",
         count(DISTINCT value) FILTER ({IS_NAME}) / any_value(width) AS "Unique",
         count(*) FILTER ({IS_FILLED}) / any_value(width) AS "Complete"
  FROM cells c JOIN width w ON c.FILE = w.FILE AND c.SHEET = w.SHEET
  WHERE c.row <= 10
  GROUP BY c.FILE, c.SHEET, c.row)
"""

WINNERS = f"""
{PROFILE},
winners AS (
  SELECT * FROM profile
  QUALIFY row_number() OVER (PARTITION BY FILE, SHEET
    ORDER BY "Valid" DESC, "Unique" DESC, "Complete" DESC, "RowNum") = 1)
"""


def table_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tb.table_dims(document_cells(spark, sf_dir))


def header_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tb.header_profile(document_cells(spark, sf_dir))


def find_header_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tb.find_header_row(document_cells(spark, sf_dir))


def header_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tb.header_values(document_cells(spark, sf_dir))
    return found.withColumn("vars", F.concat_ws("|", "vars"))


HEADER_VALUES = f"""
WITH {WINNERS}
SELECT c.FILE, c.SHEET, w."RowNum", CAST((c.col - 1) // 16384 AS BIGINT) AS PART,
       coalesce(string_agg(value, '|' ORDER BY c.col) FILTER ({IS_FILLED}), '') AS vars
FROM cells c JOIN winners w ON c.FILE = w.FILE AND c.SHEET = w.SHEET AND c.row = w."RowNum"
GROUP BY ALL
"""

QUERIES = {
    "table_dims": table_dims,
    "header_profile": header_profile,
    "find_header_row": find_header_row,
    "header_values": header_values,
}

ORACLES = {
    "table_dims": f"WITH {CELLS} SELECT FILE, SHEET, max(row) AS rows, max(col) AS columns "
    "FROM cells GROUP BY ALL",
    "header_profile": f"WITH {PROFILE} SELECT * FROM profile",
    "find_header_row": f"WITH {WINNERS} SELECT * FROM winners",
    "header_values": HEADER_VALUES,
}
