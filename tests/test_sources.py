import warnings

import pytest
from pyspark.sql import functions as F

import tablebind as tb


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "a b.csv").write_text('X,Y\n1,"say ""hi"", then go"\n2,\n', encoding="utf-8")
    (tmp_path / "c+d.csv").write_text("Y,Z\n3,4\n", encoding="utf-8")
    (tmp_path / "empty.csv").write_text("X,Y\n", encoding="utf-8")
    (tmp_path / "notes.txt").write_text("X\n9\n", encoding="utf-8")
    return tmp_path


def test_csv_files_with_different_headers(spark, folder):
    tables = tb.read_tables(spark, str(folder), "csv")
    assert sorted(t.columns for t in tables) == [
        ["FILE", "SHEET", "X", "Y"], ["FILE", "SHEET", "Y", "Z"],
    ]
    assert rows(tb.union_tables(tables).select("FILE", "SHEET", "X", "Y", "Z")) == [
        ("a b.csv", "Sheet1", "1", 'say "hi", then go', None),
        ("a b.csv", "Sheet1", "2", None, None),
        ("c+d.csv", "Sheet1", None, "3", "4"),
    ]


def test_bind_files(spark, folder):
    missing = str(folder / "nowhere.csv")
    with warnings.catch_warnings(record=True) as caught:
        warnings.simplefilter("always")
        bound = tb.bind_files(spark, [str(folder), missing], "csv")
    assert any("1 paths" in str(w.message) for w in caught)
    assert bound.data.count() == 3
    assert rows(bound.report) == [
        ("a b.csv", "Sheet1", 2, 2), ("c+d.csv", "Sheet1", 1, 1), ("empty.csv", "Sheet1", 0, None),
    ]


def test_no_files(spark, folder):
    with pytest.raises(FileNotFoundError):
        tb.read_tables(spark, str(folder), "parquet")
    with pytest.raises(FileNotFoundError), warnings.catch_warnings():
        warnings.simplefilter("ignore")
        tb.read_tables(spark, str(folder / "nowhere"), "csv")


def test_same_schema_is_checked(spark, folder):
    (one,) = tb.read_tables(spark, [str(folder / "a b.csv"), str(folder / "empty.csv")], "csv", same_schema=True)
    assert one.count() == 2
    (mixed,) = tb.read_tables(spark, str(folder), "csv", same_schema=True)
    with pytest.raises(Exception, match="(?i)header"):
        mixed.collect()


def test_workbooks_and_sheets(spark, tmp_path, monkeypatch):
    for book, sheet, text in [("w1", "s1", "A\n1\n"), ("w1", "s2", "A\n2\n"), ("w2", "t1", "A\n3\n")]:
        (tmp_path / book).mkdir(exist_ok=True)
        (tmp_path / book / f"{sheet}.csv").write_text(text)
    source = str(tmp_path)

    def read(sheet):
        (table,) = tb.read_tables(spark, source, "csv", sheet, workbooks=True)
        return rows(table)

    first = [("w1", "s1", "1"), ("w2", "t1", "3")]
    assert read(None) == [("w1", "s1", "1"), ("w1", "s2", "2"), ("w2", "t1", "3")]
    assert read(1) == first
    assert read("s2") == read(2) == [("w1", "s2", "2")]
    with pytest.warns(UserWarning, match="no such sheets: gone"):
        assert read(["t1", "gone"]) == [("w2", "t1", "3")]

    (table,) = tb.read_tables(spark, source, "csv", workbooks=True)
    assert rows(tb.select_sheet(table, 1)) == first
    assert rows(tb.select_sheet(table, [2, "t1"])) == [("w1", "s2", "2"), ("w2", "t1", "3")]
    with pytest.warns(UserWarning, match="gone"):
        assert rows(tb.select_sheet(table, ["s1", "gone"])) == [("w1", "s1", "1")]
    assert tb.select_sheet(table, None) is table
    assert tb.select_sheet(table, 9).isEmpty()
    monkeypatch.setattr("tablebind.sources.tables.FILTER_SHEETS", 1)
    assert rows(tb.select_sheet(table, 1)) == first


def test_types_that_differ_between_files(spark, tmp_path):
    spark.createDataFrame([(1,)], "v int").write.parquet(str(tmp_path / "a.parquet"))
    spark.createDataFrame([("x",)], "v string").write.parquet(str(tmp_path / "b.parquet"))
    tables = tb.read_tables(spark, str(tmp_path), "parquet")
    assert rows(tb.union_tables(tables)) == [
        ("a.parquet", "Sheet1", "1"), ("b.parquet", "Sheet1", "x"),
    ]


def test_json(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"p": 1}\n{"q": "x"}\n')
    (table,) = tb.read_tables(spark, str(tmp_path), "json")
    assert rows(table) == [("a.json", "Sheet1", "1", None), ("a.json", "Sheet1", None, "x")]


@pytest.mark.parametrize("to_fmt", ["parquet", "csv", "json", "orc"])
def test_convert_files(spark, folder, tmp_path, to_fmt):
    dst = str(tmp_path / "out" / to_fmt)
    manifest = tb.convert_files(spark, str(folder), dst, "csv", to_fmt)
    assert rows(manifest) == [
        ("a b.csv", "Sheet1", 2, 2), ("c+d.csv", "Sheet1", 1, 1), ("empty.csv", "Sheet1", 0, 0),
    ]
    assert (folder / "a b.csv").exists()
    with pytest.raises(Exception, match="(?i)exist"):
        tb.convert_files(spark, str(folder), dst, "csv", to_fmt)


def test_write_table_and_heads(spark, tmp_path):
    df = spark.createDataFrame([("b", None), ('q"t', "x"), ("a", "")], "h string, v string")
    tb.write_table(df, str(tmp_path / "t"), "csv")
    back = spark.read.csv(str(tmp_path / "t"), header=True, escape='"')
    assert rows(back) == [("a", None), ("b", None), ('q"t', "x")]
    tb.write_heads(df.select("h"), str(tmp_path / "h"))
    written = "".join(p.read_text() for p in sorted((tmp_path / "h").glob("part-*")))
    assert [line for line in written.splitlines() if line != "h"][:2] == ["a", "b"]


def test_read_documents(spark, tmp_path):
    (tmp_path / "d.txt").write_text("姓名 张三\n\n血压 120/80\n", encoding="utf-8")
    docs = tb.read_documents(spark, str(tmp_path))
    assert rows(tb.normalize_text(docs)) == [("d.txt", "姓名 张三\n血压 120/80")]


def test_narrow_operators_run_on_streams(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "d.txt").write_text("1.ok. more\nk 5")
    stream = spark.readStream.text(src, wholetext=True).withColumnRenamed("value", "text")
    rule = tb.load_rules(spark.createDataFrame([("k (\\d)", "\\1", "K")], "Pattern string, Extract string, Fld string"))
    short = tb.simplify_summary(tb.normalize_text(stream), "text", "Ciming", ender=".")
    fields = tb.extract_fields(short, rule, keep=["summ"])
    query = (
        fields.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True).start(out)
    )
    query.awaitTermination(60)
    assert rows(spark.read.parquet(out).select(F.col("K"))) == [("1.ok. more\n5",)]
