"""Quality rules on documents and on the lines that documents of a host share."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablebind.functions.names import col
from tablebind.plans.checkpoints import checkpointed
from tablebind.plans.joins import lookup

BLANKS = r"[\x20\x09-\x0D]+"
#: All but the characters that count as symbols.
OTHERS = r"[^#*$%&|<>]+"
#: Words of a window, and the base limits: fewest words, highest share of repeated ones.
WINDOW, LEAST_WORDS, REPEATED = 5, 10, 0.2


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, BLANKS), "")


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once. A column of an earlier step would not do: a filter
    pushed below that step puts the column's expression in its place, also inside a lambda."""
    return F.transform(F.array(value), body)[0]


def _repeated(text: Column) -> Column:
    """Words in windows that stand twice or more; only texts with such windows are sorted."""

    def windows(w: Column) -> Column:
        starts = F.slice(w, F.lit(1), F.greatest(F.size(w) - (WINDOW - 1), F.lit(0)))
        return F.transform(
            starts, lambda x, i: F.xxhash64(x, *[F.get(w, i + k) for k in range(1, WINDOW)])
        )

    def covered(s: Column) -> Column:
        again = F.filter(
            s,
            lambda x, k: F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False))
            | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False)),
        )
        places = F.array_sort(F.transform(again, lambda x: x["i"]))
        zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("upto"))
        return F.aggregate(
            places,
            zero,
            lambda a, i: F.struct(
                (a["n"] + WINDOW - F.greatest(a["upto"] - i, F.lit(0))).alias("n"),
                (i + WINDOW).alias("upto"),
            ),
            lambda a: a["n"],
        )

    def counted(h: Column) -> Column:
        placed = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
        twice = F.size(h) > F.size(F.array_distinct(h))
        return F.when(twice, _let(F.array_sort(placed), covered)).otherwise(F.lit(0).cast("long"))

    return _let(words(text), lambda w: _let(windows(w), counted))


def _measured(docs: DataFrame) -> DataFrame:
    """``docs`` with the counts of ``_text``."""
    text = F.col("_text")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    solid = F.regexp_replace(text, BLANKS, "")
    symbols = F.regexp_replace(text, OTHERS, "")
    return docs.withColumns(
        {
            "n_words": F.size(words(text)).cast("long"),
            "word_chars": F.length(solid).cast("long"),
            "n_symbols": F.length(symbols).cast("long"),
            "n_dup_lines": _let(
                lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")
            ),
            "n_repeat_words": _repeated(text),
        }
    )


def _lines(docs: DataFrame) -> DataFrame:
    """``_id``, ``_hash`` (of host and text), ``_line`` (number), ``_key`` (of host and line as
    compared), ``_chars`` and ``_total``.

    A line is compared in lower case with single blanks and without blanks at its ends.
    """
    flat = F.split(F.lower(F.regexp_replace("_text", r"[\x20\x09\x0B-\x0D]+", " ")), "\n")
    step = docs.select(
        "_id",
        F.xxhash64("_host", "_text").alias("_hash"),
        "_host",
        F.transform(flat, F.trim).alias("_flat"),
    )
    keys = F.transform(
        "_flat", lambda x: F.when(x != "", F.xxhash64(F.col("_host"), x))
    )
    step = step.select(
        "_id",
        "_hash",
        keys.alias("_keys"),
        F.transform("_flat", F.length).alias("_sizes"),
    )
    total = F.aggregate("_sizes", F.lit(0).cast("long"), lambda a, x: a + x)
    return step.select(
        "_id", "_hash", total.alias("_total"),
        F.posexplode(F.arrays_zip("_keys", "_sizes")).alias("_line", "_at"),
    ).select(
        "_id", "_hash", "_total", "_line",
        F.col("_at._keys").alias("_key"),
        F.col("_at._sizes").alias("_chars"),
    ).where("_key IS NOT NULL")


def frequent_lines(lines: DataFrame, max_documents: int) -> DataFrame:
    """Keys of lines above the limit: one row each.

    The distinct texts of a host that hold a line are counted, so that copies and repeated rows
    of one text are one document. Both steps combine before the shuffle.
    """
    return (
        lines.select("_key", "_hash")
        .distinct()
        .groupBy("_key")
        .count()
        .where(F.col("count") > max_documents)
        .select("_key")
    )


def quality(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    max_documents: int = 100,
    max_removed: float = 0.5,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, n_removed_lines, depleted, removed (line numbers from 0).

    Lines are hashed as compared, and the distinct texts of a host that hold a line are counted.
    Lines above ``max_documents`` are removed wherever they stand; a document that loses more
    than ``max_removed`` of its characters is depleted. A document is kept if it neither fails the
    base limits nor is depleted. Frequent lines are measured before they are broadcast.

    A null text has no words and fails; a null host is a host like any other; equal rows get
    equal results, a row each; an empty table gives none.
    """
    source = docs.select(
        col(id_col).cast("long").alias("_id"),
        F.coalesce(col(text_col).cast("string"), F.lit("")).alias("_text"),
        F.coalesce(col(host_col).cast("string"), F.lit("")).alias("_host"),
    )
    lines = _lines(source)
    frequent = checkpointed(frequent_lines(lines, max_documents))
    hit = lookup(lines, frequent, ["_key"], "inner")
    lost = (
        hit.groupBy("_id", "_hash")
        .agg(F.collect_set(F.struct("_line", "_chars")).alias("_lost"), F.max("_total").alias("_total"))
        .select(
            "_id",
            "_hash",
            F.array_sort(F.transform("_lost", lambda x: x["_line"])).alias("removed"),
            (
                F.aggregate("_lost", F.lit(0).cast("long"), lambda a, x: a + x["_chars"])
                > max_removed * F.col("_total")
            ).alias("depleted"),
        )
    )
    rated = _measured(source.withColumn("_hash", F.xxhash64("_host", "_text"))).drop("_text", "_host")
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > int(100 * REPEATED) * F.col("n_words")
    )
    removed = F.coalesce("removed", F.array().cast("array<int>"))
    return (
        lookup(rated, checkpointed(lost), ["_id", "_hash"], "left")
        .withColumn("depleted", F.coalesce("depleted", F.lit(False)))
        .withColumn("base_failed", failed)
        .select(
            F.col("_id").alias("doc_id"),
            "n_words",
            "word_chars",
            "n_symbols",
            "n_dup_lines",
            "n_repeat_words",
            "base_failed",
            (~F.col("base_failed") & ~F.col("depleted")).alias("kept"),
            F.size(removed).cast("long").alias("n_removed_lines"),
            "depleted",
            removed.alias("removed"),
            F.col("_hash").alias("row_hash"),
        )
    )
