"""Documents made into packed training sequences, stage by stage.

A stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again as
the next stage's documents. All but the last return the columns of documents.
"""

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablebind.functions.names import col
from tablebind.llm.decontaminate import find_passages, pairs_sum, without_spans
from tablebind.llm.packing import pack
from tablebind.llm.quality import quality
from tablebind.llm.secrets import masked
from tablebind.llm.simhash import near_duplicates
from tablebind.plans.checkpoints import new_folder, stored
from tablebind.plans.joins import lookup


def _text(column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(""))


def _keyed(docs: DataFrame, row_hash: Column) -> DataFrame:
    """Rows in one column, so that no name of theirs meets one of ours, beside their keys."""
    return docs.select(
        F.struct(*[col(c).alias(c) for c in docs.columns]).alias("_row"),
        col("doc_id").cast("long").alias("_id"),
        row_hash.alias("_hash"),
    )


def _rows(found: DataFrame, row: str, columns: list[str], text: Column | None = None) -> DataFrame:
    """The columns of documents again, with another text and its length if there is one."""
    new = {} if text is None else {"text": text, "n_chars": F.length(text).cast("long")}
    return found.select(*[new.get(c, F.col(row)[c]).alias(c) for c in columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that fail, and without the lines that too many documents share."""
    rated = quality(docs).select(
        F.col("doc_id").alias("_id"), F.col("row_hash").alias("_hash"), "kept", "removed"
    )
    # Equal rows have equal verdicts; only rows that change or go need to be looked up.
    told = stored(rated.where("NOT kept OR size(removed) > 0").distinct())
    keyed = _keyed(docs, F.xxhash64(_text(col("source")), _text(col("text"))))
    found = lookup(keyed, told, ["_id", "_hash"], "left").where("coalesce(kept, true)")
    old = F.col("_row")["text"]
    lines = F.filter(F.split(old, "\n", -1), lambda x, k: ~F.array_contains("removed", k))
    text = F.when(F.size("removed") > 0, F.array_join(lines, "\n")).otherwise(old)
    return _rows(found, "_row", docs.columns, text)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest id (a null id is the
    largest), and of equal rows one."""
    groups = stored(near_duplicates(docs).select("doc_id", "row_hash", "component", "component_id"))
    counted = groups.groupBy("component", "component_id", "doc_id", "row_hash").count()
    # Only rows with the smallest id of their group can stay, so no large group meets in a join.
    is_least = F.col("doc_id").eqNullSafe(F.col("component_id"))
    least = counted.where(is_least)
    first = least.groupBy("component").agg(F.min("row_hash").alias("first"))
    least = least.join(first, "component").withColumn("_stays", F.col("row_hash") == F.col("first"))
    others = counted.where(~is_least).withColumn("_stays", F.lit(False))
    # What goes, and what stays but stands in several equal rows; all others stay as they are.
    told = stored(
        least.select("doc_id", "row_hash", "_stays", "count")
        .union(others.select("doc_id", "row_hash", "_stays", "count"))
        .where("NOT _stays OR count > 1")
        .select(F.col("doc_id").alias("_id"), F.col("row_hash").alias("_hash"), "_stays")
    )
    keyed = _keyed(docs, F.xxhash64(_text(col("text"))))
    found = lookup(keyed, told, ["_id", "_hash"], "left").where("coalesce(_stays, true)")
    once = found.where("_stays").dropDuplicates(["_id", "_hash"])
    return _rows(found.where("_stays IS NULL").union(once), "_row", docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the passages of the benchmark; a document with nothing else goes."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = find_passages(docs, benchmark, keep=tuple(docs.columns))
    text = without_spans(F.col("kept")["text"], F.col("spans"))
    # All words are hit: the words of the hits are the words of the document.
    left = (pairs_sum(F.col("hits")) < F.col("n_words")) | (F.col("n_words") == 0)
    return _rows(found.where(left), "kept", docs.columns, text)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked."""
    clean = masked(docs)
    return clean.select(
        *[F.length(col("text")).cast("long").alias(c) if c == "n_chars" else col(c) for c in docs.columns]
    )


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scan),
    ("packing", packing),
]
#: Shingle hashes and token ids are beyond DuckDB's SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        path = new_folder(spark, f"stage{k}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
