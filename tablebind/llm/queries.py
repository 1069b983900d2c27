"""The operators as queries on the driver's tables, and SQL for those that SQL can express."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablebind.llm.conversations import repair_conversations
from tablebind.llm.decontaminate import find_passages, pairs_sum
from tablebind.llm.jaccard import similar_documents
from tablebind.llm.licenses import licenses
from tablebind.llm.lm import lm_scores
from tablebind.llm.negatives import hard_negatives
from tablebind.llm.packing import pack
from tablebind.llm.quality import quality
from tablebind.llm.secrets import secrets
from tablebind.llm.simhash import near_duplicates
from tablebind.llm.tokens import token_counts
from tablebind.llm.toxicity import toxicity
from tablebind.llm.warc import archived

VOCABULARY = "word_bpe_49k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_passages(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    n_hit = pairs_sum(F.col("hits"))
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets(_table(spark, sf_dir, "documents"))


def warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = archived(_table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = quality(_table(spark, sf_dir, "documents"))
    return rated.drop("removed", "row_hash")


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses(_table(spark, sf_dir, "documents"))


def lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(_table(spark, sf_dir, "documents"))


def negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    # The test's relabelling: every seventh row says another label than its neighbours do.
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", label))


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(_table(spark, sf_dir, "conversations"), test_faults=True)


def similar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(_table(spark, sf_dir, "documents")).drop("row_hash")


QUERIES = {
    "op1_decontamination": decontamination,
    "op2_simhash": simhash,
    "op3_secrets": secret_scan,
    "op4_warc": warc,
    "op5_toxicity": toxic,
    "op6_packing": packing,
    "op7_token_counts": tokens,
    "op8_quality": quality_rules,
    "op9_licenses": license_scan,
    "op10_lm_scoring": lm_scoring,
    "op11_hard_negatives": negatives,
    "op12_conversations": conversations,
    "op13_jaccard_join": similar,
}
#: Plain SQL for the two operators that SQL expresses; the others' hashes, token ids and models are
#: beyond it.
HARD_NEGATIVES = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, e.vec_id AS id, a.label = e.label AS same,
         CAST(list_dot_product(a.v, e.v) AS BIGINT) AS score
  FROM e AS a JOIN e ON a.vec_id % 100 = 0 AND a.vec_id <> e.vec_id),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS n
  FROM s WHERE same),
n AS (
  SELECT p.anchor_id, positive_id, id AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) AS rank
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND p.n <= 5
    AND 80 * positive_score <= 100 * score AND score <= positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 5
"""
SIMILAR = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(words) - 4, 1) + 1),
    lambda i: array_to_string(words[i:i + 4], ' '))) AS shingle
  FROM w WHERE len(words) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS held
  FROM s AS x JOIN s AS y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id),
links AS (
  SELECT a, b FROM shared JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b
  WHERE 100 * held >= 80 * (x.n + y.n - held)),
reach AS (
  SELECT doc_id, doc_id AS c FROM w
  UNION SELECT r.doc_id, l.b FROM reach AS r JOIN links AS l ON l.a = r.c)
SELECT r.doc_id, coalesce(max(n.n), 0) AS n_shingles, min(r.c) AS component_id
FROM reach AS r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""
ORACLES: dict[str, str] = {
    "op11_hard_negatives": HARD_NEGATIVES,
    "op13_jaccard_join": SIMILAR,
}
