"""Every operator as a query on the driver's tables, each with the same result in SQL.

A query reads whole tables. Missing values and Chinese text, which the tables lack, are
derived from their columns by expressions.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tablebind.catalog import columns, headers, reports, rows, summaries, tables, texts

Query = Callable[[SparkSession, str], DataFrame]

_FAMILIES = (tables, columns, rows, headers, texts, summaries, reports)


def queries() -> dict[str, Query]:
    return {name: query for family in _FAMILIES for name, query in family.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for family in _FAMILIES for name, sql in family.ORACLES.items()}
