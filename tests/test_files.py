"""Values that survive files: line breaks, missing values, equal names, many files."""

import pytest

import tablebind as tb
from tablebind.sources import tables
from tablebind.sources.tables import CSV_OPTIONS

HARD = ["a\nb", 'q"x\n\ny"', " blanks ", "\n", "a\r\nb", "a\rb", "plain", "x,y", "\\", "-", "\t", "\\n"]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_line_breaks_and_nulls_survive_csv(spark, tmp_path):
    data = [(k, v, None if k % 2 else "z") for k, v in enumerate([*HARD, None, ""])]
    df = spark.createDataFrame(data, "k int, v string, w string")
    src, dst = str(tmp_path / "in.parquet"), str(tmp_path / "out")
    df.write.parquet(src)
    manifest = tb.convert_files(spark, src, dst, "parquet", "csv")
    assert rows(manifest) == [("in.parquet", "Sheet1", len(data), len(data))]
    back = spark.read.options(**CSV_OPTIONS).schema("k int, v string, w string").csv(f"{dst}/FILE=in.parquet/SHEET=Sheet1")
    assert rows(back) == sorted(((k, v or None, w) for k, v, w in data), key=str)


def test_one_column_with_nulls_survives_csv(spark, tmp_path):
    src, dst = str(tmp_path / "one.parquet"), str(tmp_path / "out")
    spark.createDataFrame([(1,), (None,), (3,), (None,)], "v int").coalesce(1).write.parquet(src)
    manifest = tb.convert_files(spark, src, dst, "parquet", "csv")
    assert rows(manifest) == [("one.parquet", "Sheet1", 4, 4)]
    back = spark.read.options(**CSV_OPTIONS).schema("v int").csv(f"{dst}/FILE=one.parquet/SHEET=Sheet1")
    assert rows(back) == sorted([(1,), (None,), (3,), (None,)], key=str)


def test_quoted_line_breaks_are_read(spark, tmp_path):
    (tmp_path / "x.csv").write_text('A,"B\nC"\n1,"two\nlines"\n')
    (table,) = tb.read_tables(spark, str(tmp_path), "csv")
    assert table.columns[2:] == ["A", "B\nC"]
    assert rows(table) == [("x.csv", "Sheet1", "1", "two\nlines")]


def test_equal_file_names_stay_apart(spark, tmp_path):
    for folder, text in (("p", "A\n1\n"), ("q", "A\n2\n3\n"), ("q/r", "B\n4\n")):
        (tmp_path / "in" / folder).mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / folder / "x.csv").write_text(text)
    src = str(tmp_path / "in")
    found = tb.union_tables(tb.read_tables(spark, src, "csv"))
    names = ["p/x.csv", "q/r/x.csv", "q/x.csv"]
    assert sorted({r.FILE for r in found.collect()}) == names
    manifest = tb.convert_files(spark, src, str(tmp_path / "out"), "csv", "parquet")
    assert rows(manifest) == list(zip(names, ["Sheet1"] * 3, [1, 1, 2], [1, 1, 2]))


def test_equal_workbook_names_are_two_books(spark, tmp_path):
    for folder, sheet in (("p", "a"), ("q", "b"), ("q", "c")):
        (tmp_path / folder / "wb").mkdir(parents=True, exist_ok=True)
        (tmp_path / folder / "wb" / f"{sheet}.csv").write_text(f"V\n{sheet}\n")
    (table,) = tb.read_tables(spark, str(tmp_path), "csv", sheet=1, workbooks=True)
    first = [("p/wb", "a", "a"), ("q/wb", "b", "b")]
    assert rows(table) == first
    (whole,) = tb.read_tables(spark, str(tmp_path), "csv", workbooks=True)
    assert rows(tb.select_sheet(whole, 1)) == first


def test_headers_of_many_files_in_one_job(spark, tmp_path, monkeypatch):
    for k, text in enumerate(["A,B\n1,2\n", "\nA,B\n3,4\n", "B,A\n5,6\n", 'A,"B\nC"\n7,8\n', 'A,"B\nD"\n9,9\n', ""]):
        (tmp_path / f"f {k}+.csv").write_text(text)
    spark.createDataFrame([("1", "2")], "A string, B string").write.option("header", True).csv(str(tmp_path / "g.csv"))

    def read():
        found = tb.read_tables(spark, str(tmp_path), "csv")
        return sorted((t.columns, rows(t)) for t in found)

    usual = read()
    monkeypatch.setattr(tables, "HEADER_JOBS", 0)
    assert read() == usual
    # A file without any byte holds no table.
    assert len(usual) == 4


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_same_schema_keeps_columns_of_all_files(spark, tmp_path, fmt):
    spark.createDataFrame([(1,)], "a int").write.format(fmt).save(str(tmp_path / f"x.{fmt}"))
    spark.createDataFrame([(2, "b")], "a int, b string").write.format(fmt).save(str(tmp_path / f"y.{fmt}"))
    (table,) = tb.read_tables(spark, str(tmp_path), fmt, same_schema=True)
    assert rows(table.select("a", "b")) == [(1, None), (2, "b")]
