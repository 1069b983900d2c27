"""Files read in blocks, conversions taken up again, schemas put together, rules found by an index."""

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import tablebind as tb
from tablebind.functions.regex import contains, literal_runs, opening_text
from tablebind.operators import texts
from tablebind.sources import convert
from tablebind.sources.records import csv_records
from tablebind.operators import bind_tables
from tablebind.sources.tables import list_sheets, merged_groups


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def written(cells, rng, end="\n"):
    """A CSV file as spreadsheets write it: quotes where they are needed, or at random."""

    def cell(text):
        quoted = re.search('[",\r\n]', text) or text != text.strip() or rng.random() < 0.2
        return '"' + text.replace('"', '""') + '"' if quoted else text

    return end.join(",".join(map(cell, row)) for row in cells) + (end if rng.random() < 0.7 else "")


def table(rng, n, width=3):
    pieces = ["a", "b c", "", '"', '""', ",", "\n", "\n\n", "\r\n", "x" * 40, "字", " ", "NA", "\\", "'", "1\n2\n3\n"]
    return [["".join(rng.choices(pieces, k=rng.randrange(4))) or "-" for _ in range(width)] for _ in range(n)]


@pytest.mark.parametrize("block", ["64b", "1k", "64m"])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_csv_in_blocks_equals_whole_files(spark, tmp_path, block, end):
    """Every block size cuts records, quoted cells and line ends in other places."""
    rng = random.Random(block + end)
    for k in range(4):
        head = ["A", "B b", "C\nc"] if k % 2 else ["A", "Z", "Y"]
        text = written([head, *table(rng, 60)], rng, end)
        (tmp_path / f"f {k}+.csv").write_bytes((("﻿" if k == 3 else "") + text).encode())
    (tmp_path / "empty.csv").write_text("A,Z,Y\n")
    blank_lines = "A,Z,Y" + end + end + '1,"' + end + end + '",2' + end + end + "3,4,5" + end
    (tmp_path / "blank.csv").write_bytes(blank_lines.encode())
    (tmp_path / "short.csv").write_bytes(f"A,Z,Y{end}1{end}1,2,3,4{end}".encode())
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", block)
        split = tb.read_tables(spark, str(tmp_path), "csv", split=True)
        whole = tb.read_tables(spark, str(tmp_path), "csv", split=False)
        assert sorted(t.columns for t in split) == sorted(t.columns for t in whole)
        assert rows(tb.union_tables(split)) == rows(tb.union_tables(whole))
        assert rows(tb.union_tables(whole))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_large_csv_is_read_by_many_tasks(spark, tmp_path):
    long = "line\n" * 200
    cells = [["K", "T"], *[[str(k), f'{long}"{k}"'] for k in range(300)], ["cell of many blocks", "y\n" * 50_000]]
    (tmp_path / "big.csv").write_text(written(cells, random.Random(1)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
        (table,) = tb.read_tables(spark, str(tmp_path), "csv")  # no option: the file has many blocks
        lines = spark.read.option("lineSep", "\n").text(str(tmp_path))
        assert lines.rdd.getNumPartitions() >= 16
        assert rows(table.select("K", "T")) == sorted((tuple(c) for c in cells[1:]), key=str)
        tasks = csv_records(spark, [str(tmp_path)]).select(F.spark_partition_id().alias("p")).distinct()
        assert tasks.count() > 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_files_of_one_block_are_not_cut(spark, tmp_path):
    (tmp_path / "a.csv").write_text('A\n5" pipe\n')
    (table,) = tb.read_tables(spark, str(tmp_path), "csv")
    assert rows(table.select("A")) == [('5" pipe',)]


# ---- conversions


def sources(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for k in range(6):
        head = ["A,B", "B,C", "C,D"][k % 3]
        (folder / f"f{k}.csv").write_text(head + "\n" + "".join(f"{k},{j}\n" for j in range(k)))
    return str(folder)


def wanted():
    return [(f"f{k}.csv", "Sheet1", k, k) for k in range(6)]


@pytest.mark.parametrize("to_fmt", ["parquet", "csv", "json"])
@pytest.mark.parametrize("failing", ["write", "record"])
def test_conversion_is_taken_up_again(spark, tmp_path, monkeypatch, to_fmt, failing):
    src, dst = sources(tmp_path), str(tmp_path / "out")
    name = {"write": "_publish", "record": "_record"}[failing]
    work, calls = getattr(convert, name), []
    monkeypatch.setattr(convert, "WRITERS", 1)

    def fails_second(*args):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return work(*args)

    with monkeypatch.context() as m:
        m.setattr(convert, name, fails_second)
        with pytest.raises(RuntimeError, match="lost"):
            tb.convert_files(spark, src, dst, "csv", to_fmt)
    with pytest.raises(FileExistsError):
        tb.convert_files(spark, src, dst, "csv", to_fmt)
    written = []
    with monkeypatch.context() as m:
        m.setattr(convert, "_publish", lambda *a, f=convert._publish: (written.append(a[0]), f(*a)))
        assert rows(tb.convert_files(spark, src, dst, "csv", to_fmt, resume=True)) == wanted()
    # Threads that had begun may have ended their own schema.
    assert 1 <= len(written) <= 2
    with monkeypatch.context() as m:
        m.setattr(convert, "_publish", None)  # nothing is left to write
        assert rows(tb.convert_files(spark, src, dst, "csv", to_fmt, resume=True)) == wanted()


def test_sheets_in_files_of_several_schemas(spark, tmp_path):
    book = tmp_path / "in" / "w"
    book.mkdir(parents=True)
    (book / "s.csv").write_text("A\n1\n")
    (book / "s.CSV").write_text("B\n2\n3\n")
    (book / "t.csv").write_text("B\n4\n")
    dst = str(tmp_path / "out")
    for resume in (False, True):
        manifest = tb.convert_files(spark, str(tmp_path / "in"), dst, "csv", "json", workbooks=True, resume=resume)
        assert rows(manifest) == [("w", "s", 3, 3), ("w", "t", 1, 1)]


# ---- schemas


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_schemas_are_merged_in_few_jobs(spark, tmp_path, fmt):
    src = tmp_path / "in"
    for k in range(24):
        kind = k // 8
        names = [("a", "b"), ("c", "b"), ("a", "d")][kind]
        cast = "string" if kind == 2 else "long"
        df = spark.range(2).select(F.col("id").cast(cast).alias(names[0]), F.lit(k).alias(names[1]))
        df.coalesce(1).write.format(fmt).save(str(src / f"f{k:02}.{fmt}"))
    found = list_sheets(spark, str(src), fmt)
    tracker, group = spark.sparkContext.statusTracker(), f"merge-{fmt}"
    spark.sparkContext.setJobGroup(group, "schemas")
    tables = [t for t, _ in merged_groups(found)]
    jobs = len(tracker.getJobIdsForGroup(group))
    spark.sparkContext.setJobGroup("", "")
    assert 0 < jobs < 24
    assert len(tables) == 2
    apart = tb.union_tables(tb.read_tables(spark, str(src), fmt))
    merged = tb.union_tables(tables)
    assert rows(merged.select(*apart.columns)) == rows(apart)
    report = tb.bind_files(spark, str(src), fmt).report
    assert {r[2:] for r in rows(report)} == {(2, 2)}


def test_names_that_agree_after_cleaning_stay_apart(spark, tmp_path):
    for k, name in enumerate(["a b", "AB", "a.b", "ab"]):
        spark.range(k + 1).select(F.col("id").alias(name)).write.parquet(str(tmp_path / f"f{k}.parquet"))
    bound = tb.bind_files(spark, str(tmp_path), "parquet")
    assert bound.data.columns == ["FILE", "SHEET", "AB"]
    assert bound.data.where("AB IS NOT NULL").count() == 10
    assert [r[2:] for r in rows(bound.report)] == [(k, k) for k in (1, 2, 3, 4)]


@pytest.mark.parametrize("observed", [500, 1])
@pytest.mark.parametrize("to_fmt", ["parquet", "csv"])
def test_files_are_bound_and_counted_in_one_pass(spark, tmp_path, monkeypatch, observed, to_fmt):
    monkeypatch.setattr(bind_tables, "OBSERVED", observed)
    src = sources(tmp_path)
    (tmp_path / "in" / "gaps.csv").write_text('A,B\n"",1\nx\n')
    plain = tb.bind_files(spark, src, "csv")
    bound = tb.bind_files(spark, src, "csv", target=str(tmp_path / "out"), to_fmt=to_fmt)
    assert bound.data.columns == plain.data.columns
    assert rows(bound.data) == rows(plain.data)
    assert rows(bound.report) == rows(plain.report)


# ---- rules


def test_openings():
    assert opening_text(r"^体温\s*(.*)") == (True, "体温")
    assert opening_text(r"a\.b+c") == (False, "a.b")
    assert opening_text(r"ab?c") == (False, "a")
    assert opening_text(r"ab{0,2}c") == (False, "a")
    assert opening_text("(ab)c") == (False, "")
    assert opening_text("ab|c") == (False, "")
    assert opening_text(r"\dab") == (False, "")
    assert opening_text("(?i)ab") == (False, "")
    assert [t for _, t in literal_runs(r".+ab[)c]*de(f|g)+h\(i{2}jk?")] == ["ab", "de", "h("] + ["i"][:0] + ["j"]


parts = st.sampled_from(
    ["a", "b", "ab", "c", r"\.", "[ab]", "[^a]", "(ab)", "(a|b)", "(?:c)", ".", "a+", "b*", "c?", "a{2}", "b{0,1}", r"\w", ".+", ".*?", "$", "^", "[])]", r"\("]
)


@settings(max_examples=400, deadline=None)
@given(st.lists(parts, min_size=1, max_size=6), st.text("abc.()]", max_size=9))
def test_literal_runs_are_in_every_match(pieces, text):
    pattern = "".join(pieces)
    try:
        found = re.search(pattern, text, re.DOTALL)
    except re.error:
        return
    if found:
        assert all(run in text for _, run in literal_runs(pattern))
        at_start, opening = opening_text(pattern)
        assert (text if at_start else text[found.start() :]).startswith(opening)


def test_guarded_patterns(spark):
    df = spark.createDataFrame([("体温 36",), ("none",), (None,), ("",)], "t string")
    assert [r[0] for r in df.select(contains(F.col("t"), r"体温\s+(\d+)")).collect()] == [True, False, None, False]


def test_many_rules_by_their_openings(spark, monkeypatch):
    rng = random.Random(2)
    letters = "abcd体温."
    lines = ["".join(rng.choices(letters, k=rng.randrange(1, 12))) for _ in range(400)]
    docs = spark.createDataFrame([("\n".join(lines[k : k + 20]),) for k in range(0, 400, 20)] + [(None,), ("",)], "text string")
    opening = ["".join(rng.choices("abcd体温", k=rng.randrange(1, 10))) for _ in range(120)]
    patterns = [f".+{o}" for o in opening[:60]] + [f"{o}[a-c]" for o in opening[60:]] + [r"[.]{3}", "(ca|db)温"]
    patterns += [f"x医生.+{o}c?" for o in opening[::7]]
    rules = tb.load_rules(spark.createDataFrame([(p, "", "F") for p in patterns], "Pattern string, Extract string, Fld string"))
    found = rows(tb.unmatched_heads(docs, rules))
    monkeypatch.setattr(texts, "TRIED_RULES", 10_000)
    assert found == rows(tb.unmatched_heads(docs, rules))
    assert 0 < len(found) < len(set(lines))


# ---- feet


def test_feet_with_equal_rows_on_both_sides(spark):
    data = [("a", 1, "x")] * 7 + [("b", k, "y") for k in range(5)] + [("c", None, None)] * 4 + [(None, 1, "z")] * 3
    df = spark.createDataFrame(data, "g string, o int, v string").repartition(3)
    parts = tb.split_footer(df, 2, "o", "g")
    assert rows(parts.foot) == rows(spark.createDataFrame(
        [("a", 1, "x")] * 2 + [("b", 3, "y"), ("b", 4, "y")] + [("c", None, None)] * 2 + [(None, 1, "z")] * 2, df.schema))
    assert rows(parts.body.union(parts.foot)) == rows(df)
    with pytest.raises(ValueError, match="whole groups"):
        tb.split_footer(df, 3, "o", "g")
    with pytest.raises(ValueError, match="whole table"):
        tb.split_footer(df, len(data), "o")
    with pytest.raises(ValueError, match="whole table"):
        tb.split_footer(df.where("false"), 1, "o")
    whole = tb.split_footer(df, 6, ["o", "v"])
    assert whole.foot.count() == 6
    assert rows(whole.body.union(whole.foot)) == rows(df)


# ---- documents line by line


@pytest.mark.parametrize("block", ["32b", "64m"])
def test_headings_line_by_line(spark, tmp_path, block):
    rng = random.Random(3)
    pieces = ["a", "b c", "\n", "\r\n", "\r", "\f", "\f\f", " ", "\t", "　x y", "字 1", "\n\n", "  z z"]
    for k in range(12):
        (tmp_path / f"d{k}.txt").write_bytes("".join(rng.choices(pieces, k=40)).encode())
    (tmp_path / "blank.txt").write_bytes(b" \n \n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", block)
        found = rows(tb.document_heads(tb.read_lines(spark, str(tmp_path))))
        wanted = rows(tb.line_heads(tb.read_documents(spark, str(tmp_path)).where("doc_id <> 'blank.txt'")))
        assert found == wanted
        rules = [tb.load_rules(spark.createDataFrame([("a", "", "F")], "Pattern string, Extract string, Fld string"))[0]]
        assert rows(tb.unknown_heads(tb.document_heads(tb.read_lines(spark, str(tmp_path))), rules))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
