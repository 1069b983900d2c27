"""Cases in which results must not depend on size, nulls or the number of rules."""

import random

import pytest
from pyspark.sql import functions as F

from tablebind import (
    blank_repeats,
    bind_rows,
    find_header_row,
    header_profile,
    html_tables,
    select_sheet,
    simplify_summary,
    split_footer,
    union_tables,
    unmatched_heads,
)
from tablebind.operators import headers
from tablebind.operators.bind_columns import bind_columns
from tablebind.operators.reports import TOP_K_CONF
from tablebind.sources import tables
from tablebind.sources.dictionaries import Rule


def test_lone_long_row_keeps_its_value(spark):
    data = [(1, 1, "NA"), (2, 1, "x" * 20_000), (3, 1, "a"), (3, 2, "b")]
    df = spark.createDataFrame(data, "ID long, N long, T string")

    def merged(part_rows):
        rows = bind_rows(df, "ID", "N", {"T": True}, part_rows=part_rows).where("PART = 0")
        return sorted((r.ID, r["T"]) for r in rows.collect())

    assert merged(100_000) == merged(4)


def test_sheets_with_null_names(spark, monkeypatch):
    data = [(None, None, 1, "a"), ("f", "s", 1, "b"), ("f", "t", 2, "c")]
    df = spark.createDataFrame(data, "FILE string, SHEET string, _n int, V string")
    few = sorted(r.V for r in select_sheet(df, 1, "_n").collect())
    monkeypatch.setattr(tables, "FILTER_SHEETS", 0)
    assert few == sorted(r.V for r in select_sheet(df, 1, "_n").collect()) == ["a", "b"]


def test_many_sheets_rules_and_schemas(spark):
    df = spark.range(900).select(
        F.lit("f").alias("FILE"), F.concat(F.lit("s"), "id").alias("SHEET"), F.col("id").alias("_n")
    )
    assert select_sheet(df, list(range(1, 801)), "_n").count() == 800
    docs = spark.createDataFrame([("one: x\ntwo: y",)], "text string")
    rules = [Rule(f"head{k}[::].*", "\\0", f"F{k}") for k in range(1500)]
    unmatched_heads(docs, rules).collect()
    many = [spark.range(1).select(F.col("id").alias(f"c{k}")) for k in range(100)]
    assert len(union_tables(many).columns) == 100


def tied_rows(spark):
    draw = random.Random(5)
    data = [(draw.choice("abc"), draw.randrange(3), draw.choice(["x", "y", None])) for _ in range(90)]
    df = spark.createDataFrame(data, "g string, o int, v string").withColumn("m", F.create_map(F.lit("k"), F.lit(1)))
    return data, df


def key(row):
    return row[0], row[1], row[2] is not None, row[2] or ""


@pytest.mark.parametrize("threshold", [1000, 1])
@pytest.mark.parametrize("rows", [2, 7])
def test_footer_with_ties_has_exactly_its_rows(spark, threshold, rows):
    data, df = tied_rows(spark)
    spark.conf.set(TOP_K_CONF, threshold)
    try:
        for by in (["g"], []):
            cut = split_footer(df, rows, ["g", "o"], by)
            groups = [sorted((r for r in data if r[0] == g), key=key) for g in "abc"] if by else [sorted(data, key=key)]
            for part, want in ((cut.body, [g[:-rows] for g in groups]), (cut.foot, [g[-rows:] for g in groups])):
                found = sorted((tuple(r)[:3] for r in part.collect()), key=key)
                assert found == sorted(sum(want, []), key=key)
                assert part.columns == df.columns
    finally:
        spark.conf.unset(TOP_K_CONF)


def test_ties_have_one_order_on_every_route(spark):
    _, df = tied_rows(spark)
    df = df.drop("m")

    def blanked(limit):
        return sorted(map(str, blank_repeats(df, "v", "o", "g", limit).collect()))

    def joined(limit):
        rows = bind_rows(df, "g", "o", {"v": True}, part_rows=limit).orderBy("g", "PART").collect()
        return {g: ";".join(r["v"] for r in rows if r["g"] == g and r["v"]) for g in "abc"}

    def html(limit):
        rows = html_tables(df, "g", "o", ["v"], foot_rows=2, part_rows=limit).orderBy("g", "PART").collect()
        return {g: "".join(r["html"] for r in rows if r["g"] == g) for g in "abc"}

    for result in (blanked, joined, html):
        assert result(100_000) == result(4)


def test_empty_table_without_groups(spark):
    (row,) = html_tables(spark.createDataFrame([], "i int"), (), "i").collect()
    assert row["html"].endswith("<tbody>\n</tbody>\n</table>") and row["PART"] == 0


def test_joiner_leaves_the_text_alone(spark):
    df = spark.createDataFrame([("1.a\\r\\nb\n2.c",)], "text string")
    (row,) = simplify_summary(df, "text", "Ciming", joiner=" / ").collect()
    assert row["summ"] == "1.a\\r\\nb / 2.c"


def test_header_scans_once(spark, tmp_path):
    cells = [("f", "s", 1, 1, "a"), ("f", "s", 1, 2, "b"), ("f", "s", 2, 1, "3"), ("f", "s", 40, 4, "z")]
    spark.createDataFrame(cells, "FILE string, SHEET string, row int, col int, value string").write.parquet(str(tmp_path / "c"))
    found = find_header_row(spark.read.parquet(str(tmp_path / "c")))
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert [tuple(r) for r in found.collect()] == [("f", "s", 1, 0.5, 0.5, 0.5)]


def test_header_cells_are_dealt_once_and_uncombined(spark, tmp_path, monkeypatch):
    cells = [(f, f"s{s}", r, c, f"v{c % (r + 1)}") for f in ("f", None) for s in range(3) for r in range(1, 13) for c in range(1, 9 + s)]
    cells += [("f", None, None, 30, "x"), ("f", "only", 50, 2, "z"), ("f", "s0", 1, 1, "v1"), ("f", "s0", 2, 2, None)]
    schema = "FILE string, SHEET string, row int, col int, value string"
    spark.createDataFrame(cells, schema).write.parquet(str(tmp_path / "c"))
    df = spark.read.parquet(str(tmp_path / "c"))
    plan = header_profile(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert "HashAggregate" not in plan[plan.index("Exchange") :]
    found = sorted(header_profile(df).collect(), key=str)
    assert len(found) == 60 and {r["RowNum"] for r in found} == set(range(1, 11))
    first = next(r for r in found if (r["FILE"], r["SHEET"], r["RowNum"]) == ("f", "s2", 2))
    assert tuple(first)[3:] == (1.0, 3 / 10, 1.0)
    for limit in (0, 90):  # all sheets, or the wider ones, are too large for one task
        monkeypatch.setattr(headers, "SHEET_CELLS", limit)
        assert sorted(header_profile(df).collect(), key=str) == found


def test_mapping_check_is_the_one_that_binds(spark):
    df = spark.createDataFrame([("1", "2")], "A string, B string")
    schema = "InFile string, InDb string, BindAll boolean"
    with pytest.raises(ValueError, match="X"):
        bind_columns(df, spark.createDataFrame([("a", "x", True), ("b", "x", None)], schema))
    many = [(f"c{k}", f"t{k}", False) for k in range(12_000)]
    assert bind_columns(df, spark.createDataFrame(many, schema)).data.columns == ["A", "B"]


def test_long_texts_that_lie_together_are_parted(spark):
    data = [("g", k, "x" * (3000 if k < 20 else 1)) for k in range(400)]
    df = spark.createDataFrame(data, "g string, o int, v string")
    parts = bind_rows(df, "g", "o", {"v": True}, part_rows=10).orderBy("PART").collect()
    assert ";".join(r["v"] for r in parts) == ";".join(v for _, _, v in data)
    # No part holds more than ten kilobytes and the text that passed them.
    assert max(len(r["v"]) for r in parts) < 10 * 1024 + 3000 + 10
