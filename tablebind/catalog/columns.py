"""Merging columns by a mapping."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import tablebind as tb
from tablebind.catalog.tables import table
from tablebind.operators.bind_columns import BoundColumns, inconsistent_targets

MAP_SCHEMA = "InFile string, InDb string, BindAll boolean"
MAPPING = [
    ("tel1", "phone", False),
    ("tel2", "phone", False),
    ("note1", "note", True),
    ("note2", "note", True),
    ("note3", "note", True),
    ("nick", "name", False),
    ("old", None, False),
]


def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with contact columns in which all kinds of missing values occur."""
    key, name, segment = F.col("c_custkey"), F.col("c_name"), F.col("c_mktsegment")
    return table(spark, sf_dir, "customer").select(
        key.alias("KEY"),
        F.when(key % 4 == 0, F.lit(None)).when(key % 4 == 1, " \t").when(key % 4 == 2, "NA")
        .otherwise(F.concat(F.lit(" "), name, F.lit(" "))).alias("TEL1"),
        F.when(key % 3 == 0, F.concat(F.lit("+"), key.cast("string"))).alias("TEL2"),
        F.when(key % 5 != 0, segment).otherwise("").alias("NOTE1"),
        segment.alias("OLD"),
        F.when(key % 7 == 0, "NA").otherwise(segment).alias("NOTE2"),
        F.when(key % 2 == 0, F.concat(name, F.lit("\n"))).alias("NOTE3"),
        F.when(key % 6 == 0, name).otherwise(" NA ").alias("NICK"),
        F.col("c_acctbal").alias("BALANCE"),
    )


CONTACTS = """
SELECT c_custkey AS KEY,
  CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN NULL ELSE c_name END AS t1,
  CASE WHEN c_custkey % 3 = 0 THEN '+' || c_custkey END AS t2,
  CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS n1,
  CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment END AS n2,
  CASE WHEN c_custkey % 2 = 0 THEN c_name END AS n3,
  CASE WHEN c_custkey % 6 = 0 THEN c_name END AS nick,
  c_acctbal AS BALANCE
FROM customer
"""


def bound(spark: SparkSession, sf_dir: str) -> BoundColumns:
    mapping = spark.createDataFrame(MAPPING, MAP_SCHEMA)
    return tb.bind_columns(contacts(spark, sf_dir), mapping)


def bind_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bound(spark, sf_dir).data


def bind_columns_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bound(spark, sf_dir).data.select("KEY", "PHONE", "NAME")


def bind_columns_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bound(spark, sf_dir).data.select("KEY", "NOTE")


PHONE = "coalesce(t1, t2) AS PHONE, nick AS NAME"
NOTE = "nullif(concat_ws(';', n1, n2, n3), '') AS NOTE"


def unmapped_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns that the mapping does not know, and how many values each has."""
    found = bound(spark, sf_dir)
    known = {r["var"]: r["idx"] for r in found.unmapped.collect()}
    counts = found.data.agg(*[F.count(c).alias(c) for c in known])
    counts = counts.unpivot([], list(known), "var", "values")
    return found.unmapped.join(counts, "var").select("idx", "var", "values")


def mapping_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands as targets, of which those with parts on both sides of a size are mixed."""
    return inconsistent_targets(
        table(spark, sf_dir, "part").select(
            F.col("p_name").alias("InFile"),
            F.lower("p_brand").alias("InDb"),
            ((F.col("p_size") > 10) | F.col("p_brand").endswith("1")).alias("BindAll"),
        )
    )


MAPPING_CHECK = """
SELECT upper(p_brand) AS "InDb" FROM part GROUP BY p_brand
HAVING bool_and(p_size > 10 OR p_brand LIKE '%1') <> bool_or(p_size > 10 OR p_brand LIKE '%1')
"""

QUERIES = {
    "unmapped_columns": unmapped_columns,
    "mapping_check": mapping_check,
    "bind_columns": bind_columns,
    "bind_columns_first": bind_columns_first,
    "bind_columns_all": bind_columns_all,
}

ORACLES = {
    "unmapped_columns": "SELECT 1 AS idx, 'KEY' AS var, count(c_custkey) AS values FROM customer "
    "UNION ALL SELECT 9, 'BALANCE', count(c_acctbal) FROM customer",
    "mapping_check": MAPPING_CHECK,
    "bind_columns": f"SELECT KEY, BALANCE, {PHONE}, {NOTE} FROM ({CONTACTS})",
    "bind_columns_first": f"SELECT KEY, {PHONE} FROM ({CONTACTS})",
    "bind_columns_all": f"SELECT KEY, {NOTE} FROM ({CONTACTS})",
}
