"""Laws that hold for any input."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import tablebind as tb
from tablebind.catalog.tables import messy_tables, table
from tablebind.functions.regex import contains, replace_first, starts_at_start
from tablebind.operators.bind_tables import PROBE_ROWS, filled_columns

# Pieces whose meaning is the same in Python's and Java's dialect.
PIECES = [".+", ".*", ".*?", ".+?", "(.+)", "(.*?)", "(.+)?", "a", "b+", "(a|b)", "[ab|]", "\\|", "|b", "\\n", "$", "(b)?"]
patterns = st.lists(st.sampled_from(PIECES), min_size=1, max_size=4).map("".join)
texts = st.text(alphabet="ab|\n", max_size=8)


def replaced(pattern, text):
    found = re.search(pattern, text, re.DOTALL)
    if found is None:
        return None
    return text[: found.start()] + "<" + found.group(0) + ">" + text[found.end() :]


@settings(max_examples=400, deadline=None)
@given(patterns, texts)
def test_open_start_reaches_the_start(pattern, text):
    if starts_at_start(pattern):
        anywhere = re.search(pattern, text, re.DOTALL)
        anchored = re.match(pattern, text, re.DOTALL)
        assert (anywhere and anywhere.span()) == (anchored and anchored.span())


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(patterns, min_size=1, max_size=8), st.lists(texts, min_size=1, max_size=8))
def test_replace_first_is_the_first_match(spark, rules, given_texts):
    # Java's $ also stands before a last line break, so compare with \Z spelled out.
    java = [p.replace("$", "\\z") for p in rules]
    python = [p.replace("$", "\\Z") for p in rules]
    df = spark.createDataFrame([(t,) for t in given_texts], "t string").coalesce(1)
    t = F.col("t")
    row = df.select(
        *[F.when(contains(t, p), replace_first(t, p, "<\\0>")).alias(f"c{i}") for i, p in enumerate(java)]
    ).collect()
    for text, got in zip(given_texts, row):
        assert list(got) == [replaced(p, text) for p in python]


def test_report_balances(spark, sf_dir):
    tables, sheets = messy_tables(spark, sf_dir)
    report = tb.bind_tables(tables, sheets).report.collect()
    assert all(r["Input"] == (r["Output"] or 0) for r in report)
    assert len(report) == 4


def test_one_record_per_id(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderpriority")
    merged = tb.bind_rows(orders, "o_custkey", "o_orderkey", {"o_orderpriority": True})
    assert merged.count() == orders.select("o_custkey").distinct().count()
    pieces = merged.select(F.sum(F.size(F.split("o_orderpriority", ";")))).first()[0]
    assert pieces == orders.count()


def test_a_late_value_keeps_its_column(spark):
    late = spark.range(PROBE_ROWS * 3).coalesce(1).select(
        F.when(F.col("id") == PROBE_ROWS * 3 - 1, 1).alias("late"), F.lit(None).cast("int").alias("never")
    )
    assert filled_columns(late) == ["late"]
