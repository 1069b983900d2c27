"""Sources, sheets, stacking, dates, conversion."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import tablebind as tb
from tablebind.plans.checkpoints import new_folder
from tablebind.plans.spread import spread
from tablebind.sources.tables import CSV_OPTIONS

SOURCE_TABLES = ["customer", "supplier", "nation", "orders"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The wanted columns of a table of long texts, ready for work on each text."""
    return spread(table(spark, sf_dir, name).select(*columns))


def read_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = [f"{sf_dir}/{name}.parquet" for name in SOURCE_TABLES]
    return tb.union_tables(tb.read_tables(spark, paths, "parquet"))


READ_TABLES = """
SELECT 'customer.parquet' AS FILE, 'Sheet1' AS SHEET, CAST(COLUMNS(*) AS VARCHAR) FROM customer
UNION ALL BY NAME
SELECT 'supplier.parquet' AS FILE, 'Sheet1' AS SHEET, CAST(COLUMNS(*) AS VARCHAR) FROM supplier
UNION ALL BY NAME
SELECT 'nation.parquet' AS FILE, 'Sheet1' AS SHEET, CAST(COLUMNS(*) AS VARCHAR) FROM nation
UNION ALL BY NAME
SELECT 'orders.parquet' AS FILE, 'Sheet1' AS SHEET, CAST(COLUMNS(*) AS VARCHAR) FROM orders
"""


def shop_sheets(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Customers, suppliers and parts as three sheets of one workbook."""

    def sheet(name: str, title: str, place: int, *columns: F.Column) -> DataFrame:
        tags = [F.lit("shop").alias("FILE"), F.lit(title).alias("SHEET"), F.lit(place).alias("place")]
        return table(spark, sf_dir, name).select(*tags, *columns)

    return [
        sheet("customer", "people", 1, F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
              F.col("c_acctbal").alias("value"), F.col("c_mktsegment").alias("kind")),
        sheet("supplier", "firms", 2, F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
              F.col("s_acctbal").cast("string").alias("value")),
        sheet("part", "goods", 3, F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
              F.col("p_type").alias("kind"), F.col("p_size").alias("size")),
    ]


SHOP_SQL = """
SELECT 'shop' AS FILE, 'people' AS SHEET, '1' AS place, CAST(c_custkey AS VARCHAR) AS id,
       c_name AS name, CAST(c_acctbal AS VARCHAR) AS value, c_mktsegment AS kind,
       CAST(NULL AS VARCHAR) AS size FROM customer
UNION ALL
SELECT 'shop', 'firms', '2', CAST(s_suppkey AS VARCHAR), s_name, CAST(s_acctbal AS VARCHAR),
       NULL, NULL FROM supplier
UNION ALL
SELECT 'shop', 'goods', '3', CAST(p_partkey AS VARCHAR), p_name, NULL, p_type,
       CAST(p_size AS VARCHAR) FROM part
"""


def union_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tb.union_tables(shop_sheets(spark, sf_dir))


def select_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tb.select_sheet(union_tables(spark, sf_dir), 2, ordinal="place")


def select_sheet_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tb.select_sheet(union_tables(spark, sf_dir), ["goods", "people"])


def empty_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    gaps = F.when(F.col("o_orderstatus") == "F", "").otherwise(F.col("o_orderpriority"))
    return tb.empty_to_null(orders.select("o_orderkey", "o_orderstatus", gaps.alias("priority")))


EMPTY_TO_NULL = """
SELECT o_orderkey, o_orderstatus,
       CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS priority
FROM orders
"""


def drop_all_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``low`` has a value in some rows, ``never`` and ``nothing`` in none."""
    orders = table(spark, sf_dir, "orders")
    return tb.drop_all_null(
        orders.select(
            "o_orderkey",
            F.when(F.col("o_orderkey") < 0, F.col("o_orderpriority")).alias("never"),
            F.when(F.col("o_orderpriority") == "5-LOW", F.col("o_orderkey")).alias("low"),
            F.nullif(F.col("o_orderstatus"), F.col("o_orderstatus")).alias("nothing"),
        )
    )


DROP_ALL_NULL = """
SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN o_orderkey END AS low FROM orders
"""


def messy_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates as spreadsheet days, as yyyymmdd, written out, and as no date."""
    day = F.col("o_orderdate").cast("date")
    serial = F.date_diff(day, F.lit("1899-12-30").cast("date"))
    kind = F.col("o_orderkey") % 6
    written = (
        F.when(kind == 0, serial.cast("string"))
        .when(kind == 1, F.concat(serial.cast("string"), F.lit(".75")))
        .when(kind == 2, F.date_format(day, "yyyyMMdd"))
        .when(kind == 3, F.date_format(day, "yyyy/MM/dd HH:mm"))
        .when(kind == 4, F.date_format(day, "yyyy-MM-dd"))
        .otherwise(F.lit("unknown"))
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", written.alias("下单日期"), F.col("o_orderdate").alias("时间")
    )


def coerce_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    dates = tb.coerce_dates(messy_dates(spark, sf_dir))
    return tb.stringify(dates.withColumnsRenamed({"下单日期": "ordered", "时间": "at"}))


COERCE_DATES = """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,
       CASE WHEN o_orderkey % 6 < 5 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS ordered,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS at
FROM orders
"""


def messy_tables(spark: SparkSession, sf_dir: str) -> tuple[list[DataFrame], DataFrame]:
    """Three sheets to bind and the list of sheets, of which one is empty."""
    people, firms, _ = shop_sheets(spark, sf_dir)
    people = people.drop("place").withColumnsRenamed({"id": "i.d", "name": "full name"})
    gap = F.when(F.col("kind") == "MACHINERY", "").otherwise(F.col("kind"))
    people = people.withColumn("kind", gap).withColumn("unused", F.lit(""))
    firms = firms.drop("place").withColumnsRenamed({"id": "ID", "name": "FULL.NAME"})
    orders = messy_dates(spark, sf_dir).select(
        F.lit("sales").alias("FILE"),
        F.lit("orders").alias("SHEET"),
        F.col("o_orderkey").alias("id"),
        F.col("下单日期"),
    )
    listed = [("shop", "people"), ("shop", "firms"), ("shop", "goods"), ("sales", "orders")]
    return [people, firms, orders], spark.createDataFrame(listed, "FILE string, SHEET string")


def bind_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, sheets = messy_tables(spark, sf_dir)
    return tb.bind_tables(found, sheets).data.withColumnRenamed("下单日期", "ORDERED")


BIND_TABLES = """
SELECT 'shop' AS FILE, 'people' AS SHEET, CAST(c_custkey AS VARCHAR) AS ID, c_name AS FULLNAME,
       CAST(c_acctbal AS VARCHAR) AS "VALUE", nullif(c_mktsegment, 'MACHINERY') AS KIND,
       CAST(NULL AS VARCHAR) AS ORDERED
FROM customer
UNION ALL
SELECT 'shop', 'firms', CAST(s_suppkey AS VARCHAR), s_name, CAST(s_acctbal AS VARCHAR), NULL, NULL
FROM supplier
UNION ALL
SELECT 'sales', 'orders', CAST(o_orderkey AS VARCHAR), NULL, NULL, NULL,
       CASE WHEN o_orderkey % 6 < 5 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END
FROM orders
"""


def bind_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, sheets = messy_tables(spark, sf_dir)
    return tb.bind_tables(found, sheets).report


BIND_REPORT = """
WITH bound AS (
  SELECT 'shop' AS FILE, 'people' AS SHEET FROM customer
  UNION ALL SELECT 'shop', 'firms' FROM supplier
  UNION ALL SELECT 'sales', 'orders' FROM orders),
sheets(FILE, SHEET) AS (
  VALUES ('shop', 'people'), ('shop', 'firms'), ('shop', 'goods'), ('sales', 'orders')),
counted AS (SELECT FILE, SHEET, count(*) AS n FROM bound GROUP BY ALL)
SELECT s.FILE, s.SHEET, coalesce(c.n, 0) AS "Input", c.n AS "Output"
FROM sheets s LEFT JOIN counted c ON s.FILE = c.FILE AND s.SHEET = c.SHEET
"""


def bind_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = [f"{sf_dir}/{name}.parquet" for name in SOURCE_TABLES]
    return tb.bind_files(spark, paths, "parquet").report


BIND_FILES = """
SELECT name || '.parquet' AS FILE, 'Sheet1' AS SHEET, n AS "Input", n AS "Output" FROM (
  SELECT 'customer' AS name, count(*) AS n FROM customer
  UNION ALL SELECT 'supplier', count(*) FROM supplier
  UNION ALL SELECT 'nation', count(*) FROM nation
  UNION ALL SELECT 'orders', count(*) FROM orders)
"""


def bind_files_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files bound into a written table, with the rows that were counted on the way."""
    paths = [f"{sf_dir}/{name}.parquet" for name in SOURCE_TABLES]
    bound = tb.bind_files(spark, paths, "parquet", target=new_folder(spark, "bound"))
    written = bound.data.groupBy("FILE", "SHEET").agg(F.count(F.lit(1)).alias("written"))
    return bound.report.join(written, ["FILE", "SHEET"])


def convert_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parquet to csv below the session's shared folder; the result is the manifest."""
    paths = [f"{sf_dir}/{name}.parquet" for name in SOURCE_TABLES]
    return tb.convert_files(spark, paths, new_folder(spark, "converted"), "parquet", "csv")


def convert_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with line breaks, from parquet to csv and read again."""
    source, target = f"{sf_dir}/documents.parquet", new_folder(spark, "converted")
    tb.convert_files(spark, source, target, "parquet", "csv")
    schema = ", ".join(f"{c} string" for c in table(spark, sf_dir, "documents").columns)
    folder = f"{target}/FILE=documents.parquet/SHEET=Sheet1"
    return spark.read.options(**CSV_OPTIONS).schema(schema).csv(folder)


def convert_one_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A single column with missing values, from parquet to csv and read again."""
    source, target = f"{new_folder(spark, 'source')}/gaps.parquet", new_folder(spark, "converted")
    gaps = F.when(F.col("o_orderstatus") != "F", F.col("o_orderpriority")).alias("priority")
    tb.write_table(table(spark, sf_dir, "orders").select(gaps), source, "parquet")
    tb.convert_files(spark, source, target, "parquet", "csv")
    folder = f"{target}/FILE=gaps.parquet/SHEET=Sheet1"
    return spark.read.options(**CSV_OPTIONS).schema("priority string").csv(folder)


def convert_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A conversion that has done two files and is taken up with all of them."""
    paths = [f"{sf_dir}/{name}.parquet" for name in SOURCE_TABLES]
    target = new_folder(spark, "converted")
    tb.convert_files(spark, paths[:2], target, "parquet", "json")
    return tb.convert_files(spark, paths, target, "parquet", "json", resume=True)


def read_csv_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with line breaks as csv files, put together from the lines of their blocks."""
    folder = f"{new_folder(spark, 'source')}/documents.csv"
    tb.write_table(table(spark, sf_dir, "documents"), folder, "csv")
    (found,) = tb.read_tables(spark, folder, "csv", split=True)
    return found.drop("FILE", "SHEET")


#: Order keys in one text file.
RUN_OF_KEYS = 10_000


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of order keys as text files, so that files stay as small as they are now."""
    folder = new_folder(spark, "texts")
    lines = table(spark, sf_dir, "orders").select(
        F.floor(F.col("o_orderkey") / RUN_OF_KEYS).alias("run"),
        F.concat_ws(" ", F.col("o_orderkey").cast("string"), "o_orderpriority").alias("value"),
    )
    ordered = lines.repartition("run").sortWithinPartitions("run", "value")
    ordered.write.partitionBy("run").text(folder)
    docs = tb.read_documents(spark, folder)
    return docs.select("text", F.col("doc_id").endswith(".txt").alias("named"))


READ_DOCUMENTS = f"""
SELECT string_agg(o_orderkey || ' ' || o_orderpriority || chr(10), ''
                  ORDER BY o_orderkey || ' ' || o_orderpriority) AS text, true AS named
FROM orders GROUP BY o_orderkey // {RUN_OF_KEYS}
"""


def table_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = [f"{sf_dir}/{name}.parquet" for name in SOURCE_TABLES]
    return tb.table_dims(tb.read_tables(spark, paths, "parquet"))


TABLE_SIZES = " UNION ALL ".join(
    f"SELECT '{name}.parquet' AS FILE, 'Sheet1' AS SHEET, count(*) AS rows, CAST((SELECT count(*) "
    f"FROM (DESCRIBE {name})) AS BIGINT) AS columns FROM {name}"
    for name in SOURCE_TABLES
)


def bind_files_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = [f"{sf_dir}/{name}.parquet" for name in SOURCE_TABLES]
    data = tb.bind_files(spark, paths, "parquet").data
    return data.withColumnsRenamed({c: c.lower() for c in data.columns if c not in ("FILE", "SHEET")})


QUERIES = {
    "convert_resumed": convert_resumed,
    "read_csv_blocks": read_csv_blocks,
    "convert_documents": convert_documents,
    "convert_one_column": convert_one_column,
    "read_documents": read_documents,
    "table_sizes": table_sizes,
    "bind_files_data": bind_files_data,
    "read_tables": read_tables,
    "union_tables": union_tables,
    "select_sheet": select_sheet,
    "select_sheet_names": select_sheet_names,
    "empty_to_null": empty_to_null,
    "drop_all_null": drop_all_null,
    "coerce_dates": coerce_dates,
    "bind_tables": bind_tables,
    "bind_report": bind_report,
    "bind_files": bind_files,
    "bind_files_target": bind_files_target,
    "convert_files": convert_files,
}

ORACLES = {
    "convert_resumed": BIND_FILES,
    "read_csv_blocks": "SELECT nullif(CAST(COLUMNS(*) AS VARCHAR), '') FROM documents",
    "convert_documents": "SELECT nullif(CAST(COLUMNS(*) AS VARCHAR), '') FROM documents",
    "convert_one_column": "SELECT CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS priority "
    "FROM orders",
    "read_documents": READ_DOCUMENTS,
    "table_sizes": TABLE_SIZES,
    "bind_files_data": READ_TABLES,
    "read_tables": READ_TABLES,
    "union_tables": SHOP_SQL,
    "select_sheet": f"SELECT * FROM ({SHOP_SQL}) WHERE SHEET = 'firms'",
    "select_sheet_names": f"SELECT * FROM ({SHOP_SQL}) WHERE SHEET IN ('goods', 'people')",
    "empty_to_null": EMPTY_TO_NULL,
    "drop_all_null": DROP_ALL_NULL,
    "coerce_dates": COERCE_DATES,
    "bind_tables": BIND_TABLES,
    "bind_report": BIND_REPORT,
    "bind_files": BIND_FILES,
    "bind_files_target": f'SELECT *, "Input" AS written FROM ({BIND_FILES})',
    "convert_files": BIND_FILES,
}
