"""Merging the rows of a record."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import tablebind as tb
from tablebind.catalog.tables import table
from tablebind.plans.spread import spread

PROFILED = ["orders", "documents", "conversations", "events"]


def detect_bind_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    def modes(name: str) -> DataFrame:
        profile = tb.detect_bind_modes(tb.stringify(spread(table(spark, sf_dir, name))))
        return profile.select(F.lit(name).alias("source"), "column", "bind_all")

    return reduce(DataFrame.unionByName, [modes(name) for name in PROFILED])


VALUE_IS_NUMERIC = (
    r"regexp_matches(value, '^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"
    r"|0[xX][0-9a-fA-F]+|(?i:inf|infinity))\s*$')"
)


def _modes_sql(name: str) -> str:
    return f"""
SELECT '{name}' AS source, "column",
       count(*) FILTER (NOT regexp_matches(value, '[拒弃阴阳<>+-]') AND NOT {VALUE_IS_NUMERIC})
         / count(*) >= 0.5
       AND NOT regexp_matches(lower("column"), 'name|gender|sex|company|department|provider')
       AS bind_all
FROM (UNPIVOT (SELECT CAST(COLUMNS(*) AS VARCHAR) FROM {name}) ON COLUMNS(*)
      INTO NAME "column" VALUE value)
WHERE value NOT IN ('', 'NA')
GROUP BY "column"
"""


def order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as records of a customer, with gaps; pending ones have no customer."""
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("cust"),
        key.alias("o_orderkey"),
        F.when(key % 3 == 0, "").when(key % 7 == 0, "NA")
        .otherwise(F.col("o_orderstatus")).alias("status"),
        F.when(key % 4 != 0, F.col("o_totalprice")).alias("price"),
        F.when(key % 5 == 0, "NA").otherwise(F.col("o_orderpriority")).alias("priority"),
    )


ORDER_RECORDS = """
SELECT o_custkey AS cust, o_orderkey,
       CASE WHEN o_orderkey % 3 = 0 THEN '' WHEN o_orderkey % 7 = 0 THEN 'NA'
            ELSE o_orderstatus END AS status,
       CASE WHEN o_orderkey % 4 <> 0 THEN o_totalprice END AS price,
       CASE WHEN o_orderkey % 5 = 0 THEN 'NA' ELSE o_orderpriority END AS priority
FROM orders WHERE o_orderstatus <> 'P'
"""


def _first_sql(name: str, is_text: bool = True) -> str:
    kept = f"{name} IS NOT NULL" + (f" AND {name} NOT IN ('', 'NA')" if is_text else "")
    return (
        f"CASE WHEN count(*) = 1 THEN max({name}) "
        f"ELSE arg_min({name}, o_orderkey) FILTER ({kept}) END AS {name}"
    )


def _all_sql(name: str) -> str:
    return (
        f"CASE WHEN count(*) = 1 THEN max({name}) "
        f"ELSE string_agg({name}, ';' ORDER BY o_orderkey) "
        f"FILTER ({name} NOT IN ('', 'NA')) END AS {name}"
    )


def bind_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Modes found in the data: status concatenates, the others keep one value."""
    return tb.bind_rows(order_records(spark, sf_dir), "cust", "o_orderkey")


def bind_rows_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    modes = {"status": False, "price": False, "priority": False}
    return tb.bind_rows(order_records(spark, sf_dir), "cust", "o_orderkey", modes)


def bind_rows_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    modes = {"status": True, "priority": True}
    return tb.bind_rows(order_records(spark, sf_dir), "cust", "o_orderkey", modes)


def bind_rows_two_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole turns of a conversation and role, one text per pair."""
    talk = table(spark, sf_dir, "conversations")
    return tb.bind_rows(talk, ["conv_id", "role"], "turn", {"text": True})


BIND_TWO_IDS = """
SELECT conv_id, role, CAST(0 AS BIGINT) AS PART,
       CASE WHEN count(*) = 1 THEN max(text)
            ELSE string_agg(text, ';' ORDER BY turn, text) FILTER (text NOT IN ('', 'NA')) END AS text
FROM conversations GROUP BY conv_id, role
"""


def bind_rows_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The route of oversized records, taken by every customer with more than 4 orders."""
    modes = {"priority": True, "price": False}
    return tb.bind_rows(order_records(spark, sf_dir), "cust", "o_orderkey", modes, part_rows=4)


BIND_PARTS = f"""
WITH numbered AS (
  SELECT *, row_number() OVER (PARTITION BY cust ORDER BY o_orderkey) - 1 AS pos,
         count(*) OVER (PARTITION BY cust) AS size
  FROM ({ORDER_RECORDS})),
parts AS (
  SELECT cust, CAST(pos // 4 AS BIGINT) AS PART,
         CASE WHEN max(size) = 1 THEN max(priority)
              ELSE string_agg(priority, ';' ORDER BY o_orderkey)
                   FILTER (priority NOT IN ('', 'NA')) END AS priority
  FROM numbered GROUP BY ALL),
firsts AS (
  SELECT cust, arg_min(price, o_orderkey) FILTER (price IS NOT NULL) AS price
  FROM numbered GROUP BY cust)
SELECT p.cust, p.PART, p.priority, CASE WHEN p.PART = 0 THEN f.price END AS price
FROM parts p JOIN firsts f ON p.cust = f.cust
"""


def _bind_sql(*columns: str) -> str:
    picked = ", ".join(columns)
    return (
        f"SELECT cust, CAST(0 AS BIGINT) AS PART, {picked} FROM ({ORDER_RECORDS}) GROUP BY cust"
    )


QUERIES = {
    "detect_bind_modes": detect_bind_modes,
    "bind_rows": bind_rows,
    "bind_rows_first": bind_rows_first,
    "bind_rows_all": bind_rows_all,
    "bind_rows_two_ids": bind_rows_two_ids,
    "bind_rows_parts": bind_rows_parts,
}

ORACLES = {
    "detect_bind_modes": " UNION ALL ".join(_modes_sql(name) for name in PROFILED),
    "bind_rows": _bind_sql(_all_sql("status"), _first_sql("price", False), _first_sql("priority")),
    "bind_rows_first": _bind_sql(
        _first_sql("status"), _first_sql("price", False), _first_sql("priority")
    ),
    "bind_rows_all": _bind_sql(_all_sql("status"), _all_sql("priority")),
    "bind_rows_two_ids": BIND_TWO_IDS,
    "bind_rows_parts": BIND_PARTS,
}
