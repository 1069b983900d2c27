"""Whole text files as rows."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_documents(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One row per UTF-8 text file: ``doc_id`` (the file name) and ``text``."""
    files = spark.read.text(paths if isinstance(paths, str) else list(paths), wholetext=True)
    return files.select(
        F.col("_metadata.file_name").alias("doc_id"), F.col("value").alias("text")
    )


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One row per line: doc_id, path, text, and the line's place in the file (``block``, then ``at``).

    For documents that are too large for a row: a file is read by as many tasks as it has blocks.
    ``at`` orders the lines of a block only, and its values are those of this read.
    """
    lines = spark.read.option("lineSep", "\n").text(paths if isinstance(paths, str) else list(paths))
    return lines.select(
        F.col("_metadata.file_name").alias("doc_id"),
        F.col("_metadata.file_path").alias("path"),
        F.col("value").alias("text"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
    )
