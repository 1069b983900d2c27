"""Secrets in texts: a trigram index picks the texts that each rule is tried on."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablebind.functions.names import col
from tablebind.llm.trigrams import trigram_query
from tablebind.plans.checkpoints import checkpointed
from tablebind.plans.joins import lookup


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: The base kinds, in their order, and those the operator adds.
BASE_RULES = (
    Rule(
        "assign",
        r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        2,
        6,
    ),
    Rule("access", "AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", "[0-9a-f]+", 0, 24),
)
MORE_RULES = (
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{5,}"),
)
RULES = BASE_RULES + MORE_RULES
MASK = "[SECRET]"
#: Numbers that are summed up in one go where an array is long.
STEP = 64


def trigram_postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """The index: ``_id``, ``_hash``, ``trigram`` for each text and each trigram it holds."""
    lowered = docs.select("_id", "_hash", F.lower("_text").alias("_low"))
    held = [F.when(F.contains(F.col("_low"), F.lit(t)), F.lit(t)) for t in trigrams]
    return lowered.select("_id", "_hash", F.explode(F.array_compact(F.array(*held))).alias("trigram"))


def candidates(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``_id``, ``_hash``, ``kinds``: the rules whose trigram query a text meets.

    A clause is met when the postings of all its trigrams name the text: each trigram is a bit,
    and the bits of a text are put together before and after one shuffle of keys.
    """
    clauses = [
        (rule.kind, k, sorted(clause))
        for rule in rules
        for k, clause in enumerate(trigram_query(rule.pattern) or [])
    ]
    wanted = [
        (kind, k, (1 << len(clause)) - 1, 1 << bit, trigram)
        for kind, k, clause in clauses
        for bit, trigram in enumerate(clause)
    ]
    queries = docs.sparkSession.createDataFrame(
        wanted, "kind string, clause int, need long, bit long, trigram string"
    )
    postings = trigram_postings(docs, sorted({w[-1] for w in wanted}))
    return (
        postings.join(F.broadcast(queries), "trigram")  # as long as the rules' patterns
        .groupBy("_id", "_hash", "kind", "clause", "need")
        .agg(F.bit_or("bit").alias("met"))
        .where("met = need")
        .groupBy("_id", "_hash")
        .agg(F.collect_set("kind").alias("kinds"))  # at most one for each rule
    )


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.transform(F.array(value), body)[0]


def running(values: Column, zero: int, add: Callable[[Column, Column], Column], level: int = 2) -> Column:
    """For each whole number of an array, what ``add`` makes of all before it.

    Runs of STEP numbers are put together, and runs of runs, so that a number costs a few steps
    however long the array is.
    """

    def of(a: Column, at: Column, n: Column) -> Column:
        return F.aggregate(F.slice(a, at + 1, n), F.lit(zero), add)

    if level == 0:
        return _let(values, lambda a: F.transform(a, lambda _, i: of(a, F.lit(0), i)))

    def placed(a: Column, before: Column) -> Column:
        def one(_, i: Column) -> Column:
            run = F.floor(i / STEP).cast("int")
            return add(before[run], of(a, run * STEP, i % STEP))

        return F.transform(a, one)

    def runs(a: Column) -> Column:
        last = F.floor(F.greatest(F.size(a) - 1, F.lit(0)) / STEP).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda k: of(a, k * STEP, F.lit(STEP)))

    return _let(values, lambda a: _let(running(runs(a), zero, add, level - 1), lambda before: placed(a, before)))


def _spans(text: Column, rule: Rule, size: Callable[[Column], Column]) -> Column:
    """Places of a rule's matches: what lies between matches, and the matches, add up."""
    between = F.split(text, rule.pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    found = F.transform(
        F.arrays_zip(between.alias("b"), whole.alias("w"), value.alias("v")),
        lambda x: F.struct(
            size(x["b"]).alias("gap"),
            F.coalesce(size(x["w"]), F.lit(0)).alias("own"),
            F.coalesce(F.length(x["v"]) >= rule.least, F.lit(False)).alias("kept"),
        ),
    )

    def spans(found: Column) -> Column:
        steps = F.transform(found, lambda x: x["gap"] + x["own"])
        return _let(running(steps, 0, lambda a, b: a + b), lambda at: listed(found, at))

    def listed(found: Column, at: Column) -> Column:
        every = F.transform(
            found,
            lambda x, i: F.struct(
                (at[i] + x["gap"]).alias("start"),
                (at[i] + x["gap"] + x["own"]).alias("end"),
                F.lit(rule.kind).alias("kind"),
                x["kept"].alias("kept"),
            ),
        )
        return F.transform(
            F.filter(every, lambda x: x["kept"]), lambda x: F.struct(x["start"], x["end"], x["kind"])
        )

    return _let(found, spans)


def _ranked(spans: Column, rank: int) -> Column:
    return F.transform(
        spans,
        lambda x: F.struct(
            x["start"].alias("start"), F.lit(rank).alias("rank"), x["end"].alias("end"), x["kind"].alias("kind")
        ),
    )


def _count(spans: Column, rank: int) -> Column:
    return F.size(F.filter(spans, lambda x: x["rank"] == rank)).cast("long")


def find_secrets(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, size: Callable[[Column], Column] = F.length
) -> DataFrame:
    """``docs`` (``_id``, ``_text``, others) with ``_spans``: structs of start, end (code points, or as
    ``size`` measures; end exclusive) and kind, by start and then in the order of ``rules``."""
    none = F.array().cast("array<struct<start:int,end:int,kind:string>>")
    keyed = docs.withColumn("_hash", F.xxhash64("_text"))
    indexed = tuple(r for r in rules if trigram_query(r.pattern))
    found = keyed.withColumn("_kinds", F.array().cast("array<string>"))
    if indexed:
        met = checkpointed(candidates(keyed.select("_id", "_hash", "_text"), indexed))
        found = lookup(keyed, met.withColumnRenamed("kinds", "_kinds"), ["_id", "_hash"], "left")
    lists = []
    for k, rule in enumerate(rules):
        tried = F.col("_text").rlike(rule.pattern)
        if rule in indexed:
            tried = F.array_contains("_kinds", rule.kind) & tried
        elif rule.group == 0 and rule.pattern.endswith("]+"):
            # A run of one class: no shorter run can do, so look for a long one first.
            tried = F.col("_text").rlike(f"{rule.pattern[:-1]}{{{rule.least},}}")
        spans = F.when(F.coalesce(tried, F.lit(False)), _spans(F.col("_text"), rule, size)).otherwise(none)
        lists.append(_ranked(spans, k))
    return found.withColumn("_spans", F.array_sort(F.concat(*lists))).drop("_kinds", "_hash")


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ","
    )


def secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    more: tuple[Rule, ...] = MORE_RULES,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    Each rule's regular expression gives a Boolean query over trigrams; the index holds the
    trigrams that any query names. Texts that meet a query are verified with the expression;
    rules without a mandatory trigram (long hex runs) scan every text.

    A null text is empty: no spans, the digest of the empty text. Repeated rows get a row each;
    a null id is a key like any other; an empty table gives no rows. Other columns are not read.
    """
    source = docs.select(
        col(id_col).cast("long").alias("_id"),
        F.coalesce(col(text_col).cast("string"), F.lit("")).alias("_text"),
    )
    found = find_secrets(source, BASE_RULES + more).select("_id", "_spans")
    names = [r.kind for r in BASE_RULES]
    base = F.filter("_spans", lambda x: x["rank"] < len(names))
    counts = [_count(F.col("_spans"), k).alias(f"n_{name}") for k, name in enumerate(names)]
    return found.select(
        F.col("_id").alias("doc_id"),
        *counts,
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("_spans")).alias("spans"),
    )


def masked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every found span replaced by MASK; spans that touch or overlap are one.

    All rows and columns stay; a null text stays null, a text without secrets as it is.
    """
    kept = [col(c).alias(c) for c in docs.columns]
    source = docs.select(
        F.struct(*kept).alias("_row"),
        col(id_col).cast("long").alias("_id"),
        F.coalesce(col(text_col).cast("string"), F.lit("")).alias("_text"),
    )
    # Places in bytes, which are found in a long text without counting its characters.
    found = find_secrets(source, size=F.octet_length)

    def parts(data: Column, covered: Column) -> Column:
        """The text between spans; ``covered`` is where those before each have ended."""
        every = F.transform(
            "_spans",
            lambda x, i: F.when(
                (x["start"] > covered[i]) | (i == 0),
                F.substring(data, covered[i] + 1, x["start"] - covered[i]).cast("string"),
            ),
        )
        upto = F.array_max(F.transform("_spans", lambda x: x["end"]))
        rest = F.substring(data, upto + 1, F.octet_length("_text") - upto).cast("string")
        return F.array_join(F.concat(F.array_compact(every), F.array(rest)), MASK)

    ends = F.transform("_spans", lambda x: x["end"])
    clean = _let(
        F.col("_text").cast("binary"),
        lambda data: _let(running(ends, 0, lambda a, b: F.greatest(a, b)), lambda upto: parts(data, upto)),
    )
    text = F.when(F.size("_spans") > 0, clean).otherwise(F.col("_row")[text_col])
    return found.select(
        *[
            text.alias(c) if c == text_col else F.col("_row")[c].alias(c)
            for c in docs.columns
        ]
    )

