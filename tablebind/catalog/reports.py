"""Report tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import tablebind as tb
from tablebind.catalog.tables import table

SHOWN = ["c_nationkey", "c_custkey", "c_name", "c_acctbal"]
HEADING = [["Nation", "Customer", None, "Balance"], [None, "Key", "Name", None]]
CAPTION = "Customers by nation"
FOOT_ROWS = 2


def blank_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey", "c_mktsegment")
    return tb.blank_repeats(customer, "c_mktsegment", "c_custkey", "c_nationkey")


BLANK_REPEATS = """
SELECT c_nationkey, c_custkey,
       CASE WHEN c_mktsegment = lag(c_mktsegment) OVER (PARTITION BY c_nationkey ORDER BY c_custkey)
            THEN '' ELSE c_mktsegment END AS c_mktsegment
FROM customer
"""


def blank_repeats_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole table in one order, by sorted partitions instead of one task."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    shown = orders.withColumn("priority", F.col("o_orderpriority"))
    return tb.blank_repeats(
        shown, ["priority", "o_orderstatus"], ["o_orderpriority", "o_orderkey"], group_rows=1000
    )


BLANK_WHOLE = """
SELECT o_orderkey, o_orderpriority,
       CASE WHEN o_orderpriority = lag(o_orderpriority) OVER w THEN '' ELSE o_orderpriority END
         AS priority,
       CASE WHEN o_orderstatus = lag(o_orderstatus) OVER w THEN '' ELSE o_orderstatus END
         AS o_orderstatus
FROM orders WINDOW w AS (ORDER BY o_orderpriority, o_orderkey)
"""


def split_footer(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = tb.split_footer(table(spark, sf_dir, "orders"), 3, "o_orderkey", "o_orderpriority")
    return split.body.withColumn("section", F.lit("body")).unionByName(
        split.foot.withColumn("section", F.lit("foot"))
    )


SPLIT_FOOTER = """
SELECT *, CASE WHEN row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey DESC) <= 3
               THEN 'foot' ELSE 'body' END AS section
FROM orders
"""


def split_footer_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = tb.split_footer(table(spark, sf_dir, "orders"), 5, ["o_totalprice", "o_orderkey"])
    return split.body.withColumn("section", F.lit("body")).unionByName(
        split.foot.withColumn("section", F.lit("foot"))
    )


SPLIT_WHOLE = """
SELECT *, CASE WHEN row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey DESC) <= 5
               THEN 'foot' ELSE 'body' END AS section
FROM orders
"""


def _tables(spark: SparkSession, sf_dir: str, **options: object) -> DataFrame:
    return tb.html_tables(
        table(spark, sf_dir, "customer"),
        "c_mktsegment",
        ["c_nationkey", "c_custkey"],
        SHOWN,
        HEADING,
        foot_rows=FOOT_ROWS,
        align=["r", "l"],
        blank="c_nationkey",
        caption=CAPTION,
        **options,
    )


def html_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tables(spark, sf_dir)


def html_tables_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The route of oversized tables: pieces of 20 rows."""
    return _tables(spark, sf_dir, part_rows=20)


def _cell_sql(side: str, text: str) -> str:
    return f"""'   <td style="text-align:{side};"> ' || {text} || ' </td>' || chr(10)"""


def _head_sql(attributes: str, text: str) -> str:
    return f"""'   <th {attributes};"> {text} </th>' || chr(10)"""


OPENING = " || ".join(
    [
        f"'<table width=100%>' || chr(10) || '<caption>{CAPTION}</caption>' || chr(10)",
        "' <thead>' || chr(10) || '  <tr>' || chr(10)",
        _head_sql('rowspan="2" style="text-align:right', "Nation"),
        _head_sql('colspan="2" style="text-align:center', "Customer"),
        _head_sql('rowspan="2" style="text-align:left', "Balance"),
        "'  </tr>' || chr(10) || '  <tr>' || chr(10)",
        _head_sql('style="text-align:left', "Key"),
        _head_sql('style="text-align:left', "Name"),
        "'  </tr>' || chr(10) || ' </thead>' || chr(10) || '<tbody>' || chr(10)",
    ]
)

LINE = " || ".join(
    [
        "'  <tr>' || chr(10)",
        _cell_sql(
            "right",
            "CASE WHEN c_nationkey = lag(c_nationkey) OVER w THEN '' "
            "ELSE CAST(c_nationkey AS VARCHAR) END",
        ),
        _cell_sql("left", "c_custkey"),
        _cell_sql("left", "c_name"),
        _cell_sql("left", "c_acctbal"),
        "'  </tr>' || chr(10)",
    ]
)


def _html_sql(part_rows: int) -> str:
    return f"""
WITH lines AS (
  SELECT c_mktsegment, {LINE} AS line, row_number() OVER w - 1 AS pos,
         count(*) OVER (PARTITION BY c_mktsegment) AS size
  FROM customer WINDOW w AS (PARTITION BY c_mktsegment ORDER BY c_nationkey, c_custkey)),
pieces AS (
  SELECT c_mktsegment, pos,
         CASE WHEN pos = 0 THEN {OPENING} ELSE '' END
         || CASE WHEN pos = size - {FOOT_ROWS}
                 THEN '</tbody>' || chr(10) || '<tfoot>' || chr(10) ELSE '' END
         || line
         || CASE WHEN pos = size - 1 THEN '</tfoot>' || chr(10) || '</table>' ELSE '' END AS piece
  FROM lines)
SELECT c_mktsegment, CAST(pos // {part_rows} AS BIGINT) AS PART,
       string_agg(piece, '' ORDER BY pos) AS html
FROM pieces GROUP BY ALL
"""


QUERIES = {
    "blank_repeats": blank_repeats,
    "blank_repeats_whole": blank_repeats_whole,
    "split_footer": split_footer,
    "split_footer_whole": split_footer_whole,
    "html_tables": html_tables,
    "html_tables_parts": html_tables_parts,
}

ORACLES = {
    "blank_repeats": BLANK_REPEATS,
    "blank_repeats_whole": BLANK_WHOLE,
    "split_footer": SPLIT_FOOTER,
    "split_footer_whole": SPLIT_WHOLE,
    "html_tables": _html_sql(100_000),
    "html_tables_parts": _html_sql(20),
}
