"""CSV records whose cells hold line breaks, read from any number of blocks of a file.

A line begins a record if an even number of quotes stands before it. Quotes are counted by block,
sums over the few blocks tell how each begins, and running sums within a block tell the rest.
Records that lie in one block are put together there; only the first and last piece of a block
are taken across blocks.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablebind.plans.checkpoints import checkpointed
from tablebind.plans.joins import lookup

PATH, BLOCK, RECORD = "path", "block", "record"


def _lines(spark: SparkSession, paths: Sequence[str], quote: str) -> DataFrame:
    """Lines with the block (split) they begin in, their order there and their number of quotes.

    The order is that of the rows a task reads, so it is comparable within a block only.
    """
    lines = spark.read.option("lineSep", "\n").text(list(paths))
    quotes = F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit("")))
    return lines.select(
        F.col("_metadata.file_path").alias(PATH),
        F.col("_metadata.file_block_start").alias(BLOCK),
        F.monotonically_increasing_id().alias("at"),
        "value",
        quotes.alias("quotes"),
    )


def _joined(order: str) -> Column:
    """The texts of a group, one a line, in order."""
    held = F.array_sort(F.collect_list(F.struct(order, "value")))
    return F.array_join(F.transform(held, lambda x: x["value"]), "\n")


def csv_records(spark: SparkSession, paths: Sequence[str], quote: str = '"') -> DataFrame:
    """The records of CSV files as text: path (as Spark writes it), value, and whether it is the first
    of its file (``first``).

    Quotes stand only around cells, and doubled inside them. Lines end with a line feed; where
    the first line of a file has a carriage return before it, all such pairs are line ends, and line
    feeds inside cells. Empty lines between records are left out. The lines are shuffled once, by
    block; a record may be as long as a row.
    """
    lines = _lines(spark, paths, quote)
    blocks = lines.groupBy(PATH, BLOCK).agg(
        F.sum("quotes").alias("quotes"), F.min_by(F.col("value").endswith("\r"), "at").alias("crlf")
    )
    order = Window.partitionBy(PATH).orderBy(BLOCK)
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    # One row a block of the files. The first line of a file tells how its lines end.
    before = checkpointed(
        blocks.select(
            PATH,
            BLOCK,
            F.coalesce(F.sum("quotes").over(earlier), F.lit(0)).alias("before"),
            F.first("crlf").over(order).alias("crlf"),
        )
    )
    block = Window.partitionBy(PATH, BLOCK)
    ordered = block.orderBy("at")
    above = F.coalesce(F.sum("quotes").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    outside = (F.col("before") + above) % 2 == 0
    is_blank = (F.col("value") == "") | (F.col("crlf") & (F.col("value") == "\r"))
    pieces = (
        lookup(lines, before, [PATH, BLOCK], "inner")
        .withColumn("outside", outside)
        .where(~(F.col("outside") & is_blank))
        .withColumn(RECORD, F.sum(F.col("outside").cast("long")).over(ordered))
        .withColumn("records", F.sum(F.col("outside").cast("long")).over(block))
        .groupBy(PATH, BLOCK, RECORD, "records", "crlf")
        .agg(_joined("at").alias("value"))
    )
    # What may go on in the next block, and what has come from the one before.
    open_ended = (F.col(RECORD) == 0) | (F.col(RECORD) == F.col("records"))
    chain = F.sum((F.col(RECORD) > 0).cast("long")).over(Window.partitionBy(PATH).orderBy(BLOCK, RECORD))
    across = (
        pieces.where(open_ended)
        .withColumn("chain", chain)
        .withColumn("order", F.struct(BLOCK, RECORD))
        .groupBy(PATH, "chain", "crlf")
        .agg(F.min("order").alias("start"), _joined("order").alias("value"))
        .select(PATH, F.col(f"start.{BLOCK}").alias(BLOCK), F.col(f"start.{RECORD}").alias(RECORD), "value", "crlf")
    )
    within = pieces.where(~open_ended).select(PATH, BLOCK, RECORD, "value", "crlf")
    # The first block of a file with any record: usually that at 0.
    first = (F.col(BLOCK) == 0) & (F.col(RECORD) == 1)
    text = F.regexp_replace(F.replace("value", F.lit("\r\n"), F.lit("\n")), "\r$", "")
    text = F.when(F.col("crlf"), text).otherwise(F.col("value"))
    return within.union(across).select(PATH, text.alias("value"), first.alias("first"))
