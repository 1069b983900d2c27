"""Hand-worked rows for what the driver tables lack: nulls and Chinese text."""

import datetime

import pytest
from pyspark.sql import functions as F

import tablebind as tb
from tablebind.functions.missing import is_missing, is_numeric
from tablebind.functions.regex import replace_first
from tablebind.operators.bind_columns import inconsistent_targets
from tablebind.operators.summaries import resolve_column
from tablebind.operators.texts import head_patterns
from tablebind.sources.dictionaries import Rule


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_dates(spark):
    given = ["45123", "45123.75", "20240229", "2024/03/05 10:00", "2024-3-5", "20240230", "abc", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(given)], "i int, `体检日期` string")
    out = [r[1] for r in sorted(rows(tb.coerce_dates(df)))]
    day = datetime.date
    assert out == [
        day(2023, 7, 16), day(2023, 7, 16), day(2024, 2, 29), day(2024, 3, 5), day(2024, 3, 5),
        None, None, None,
    ]


def test_dates_of_date_types_and_other_names(spark):
    df = spark.sql("select timestamp'2024-01-02 03:04:05' as `时间`, '45123' as other, 45123.5D as `日期`")
    assert rows(tb.coerce_dates(df)) == [
        (datetime.date(2024, 1, 2), "45123", datetime.date(2023, 7, 16))
    ]


def test_names(spark):
    assert tb.normalize_names(spark.createDataFrame([(1,)], ["p. name"])).columns == ["PNAME"]
    with pytest.raises(ValueError, match="AB"):
        tb.normalize_names(spark.createDataFrame([(1, 2)], ["a.b", "A B"]))


def test_empty_and_all_null(spark):
    df = spark.createDataFrame([("", "x", None), ("a", None, None)], "p string, q string, r int")
    assert rows(tb.empty_to_null(df)) == [(None, "x", None), ("a", None, None)]
    assert tb.drop_all_null(df).columns == ["p", "q"]


def test_bind_tables_reports_empty_sheets(spark):
    one = spark.createDataFrame([("f", "s", 1, ""), ("f", "s", 2, "y")], "FILE string, SHEET string, `a.` int, b string")
    two = spark.createDataFrame([("f", "t", "x", None)], "FILE string, SHEET string, A string, c string")
    sheets = spark.createDataFrame([("f", "s"), ("f", "t"), ("g", "s")], "FILE string, SHEET string")
    bound = tb.bind_tables([one, two], sheets)
    assert bound.data.columns == ["FILE", "SHEET", "A", "B"]
    assert sorted(rows(bound.data), key=str) == [
        ("f", "s", "1", None), ("f", "s", "2", "y"), ("f", "t", "x", None),
    ]
    assert sorted(rows(bound.report), key=str) == [
        ("f", "s", 2, 2), ("f", "t", 1, 1), ("g", "s", 0, None),
    ]


MAPPING = [
    ("TEL1", "PHONE", False), ("TEL2", "PHONE", False), ("NOTE1", "NOTE", True),
    ("NOTE2", "NOTE", True), ("OLD", None, False),
]
MAP_SCHEMA = "InFile string, InDb string, BindAll boolean"


def test_bind_columns(spark):
    df = spark.createDataFrame(
        [
            ("f1", "s1", None, " 123 ", "a", "b", "x", 40),
            ("f1", "s1", "555", "123", "NA", "", "x", 41),
            ("f1", "s1", None, None, "b", "b", None, 42),
        ],
        "FILE string, SHEET string, TEL1 string, TEL2 string, NOTE1 string, NOTE2 string,"
        " OLD string, AGE int",
    )
    bound = tb.bind_columns(df, spark.createDataFrame(MAPPING, MAP_SCHEMA))
    assert bound.data.columns == ["FILE", "SHEET", "PHONE", "NOTE", "AGE"]
    assert sorted(rows(bound.data), key=lambda r: r[4]) == [
        ("f1", "s1", "123", "a;b", 40), ("f1", "s1", "555", None, 41), ("f1", "s1", None, "b;b", 42),
    ]
    assert rows(bound.unmapped) == [(8, "AGE")]


def test_bind_columns_existing_target_and_order(spark):
    df = spark.createDataFrame([("z", " t ", "s", "u")], "Z string, PHONE string, TEL1 string, W string")
    mapping = spark.createDataFrame([("tel1", "phone", False)], MAP_SCHEMA)
    bound = tb.bind_columns(df, mapping)
    # the target already stands in the table and takes part in table order
    assert bound.data.columns == ["PHONE", "Z", "W"]
    assert rows(bound.data) == [("t", "z", "u")]


def test_mapping_must_be_uniform(spark):
    mixed = spark.createDataFrame([("A", "X", True), ("B", "X", False), ("C", "Y", True)], MAP_SCHEMA)
    with pytest.raises(ValueError, match="X"):
        tb.bind_columns(spark.createDataFrame([("1",)], "A string"), mixed)
    assert rows(inconsistent_targets(mixed)) == [("X",)]


RECORDS = [(1, 1, None, "abnormal x"), (2, 1, "Li", "see y"), (3, 2, "Wu", None), (4, None, "Zz", "q")]


def test_bind_rows(spark):
    df = spark.createDataFrame(RECORDS, "N int, ID int, NAME string, RESULT string")
    out = tb.bind_rows(df, "ID", "N")
    assert out.columns == ["ID", "PART", "NAME", "RESULT"]
    assert sorted(rows(out)) == [(1, 0, "Li", "abnormal x;see y"), (2, 0, "Wu", None)]


def test_bind_rows_keeps_lone_rows_and_drops_only_exact_na(spark):
    df = spark.createDataFrame(
        [(1, 1, "NA", ""), (1, 2, "NA", "NA"), (2, 2, "DNA", "NAME"), (3, 2, "", "")],
        "N int, ID int, A string, B string",
    )
    out = tb.bind_rows(df, "ID", "N", {"A": False, "B": True})
    assert sorted(rows(out)) == [(1, 0, "NA", ""), (2, 0, "DNA", "NAME")]


def test_bind_modes(spark):
    lab = ["阳性", "12", "-3", "5", "abc"]
    df = spark.createDataFrame(
        [(v, str(i), "some text", f"t{i}", None, i) for i, v in enumerate(lab)],
        "LAB string, `检查小结` string, provider_note string, remark string, nothing string, n int",
    )
    assert dict(rows(tb.detect_bind_modes(df))) == {
        "LAB": False, "检查小结": True, "provider_note": False, "remark": True, "nothing": False,
        "n": False,
    }


def test_missing_and_numeric(spark):
    given = ["12", " 12 ", "1e3", "0x1F", "Inf", "-.5", "1.", "1d", "NaN", "", "NA", ".", "１"]
    df = spark.createDataFrame([(v,) for v in given], "v string")
    numeric = [r[0] for r in df.where(is_numeric(F.col("v"))).collect()]
    assert numeric == given[:7]
    assert [r[0] for r in df.where(is_missing(F.col("v"))).collect()] == ["", "NA"]


CELLS = [
    (1, ["Report", None, None]), (2, ["id", "name", "sex"]), (3, ["1", "Li", "F"]),
]


def test_header_row(spark):
    cells = spark.createDataFrame(
        [("f", "s", r, c, v) for r, vs in CELLS for c, v in enumerate(vs, 1)],
        "FILE string, SHEET string, row int, col int, value string",
    )
    profile = {r[2]: r[3:] for r in rows(tb.header_profile(cells))}
    third = 1 / 3
    assert profile == {1: (third, third, third), 2: (1.0, 1.0, 1.0), 3: (2 / 3, 2 / 3, 1.0)}
    assert tb.header_profile(cells, na_rm=True).where("RowNum = 1").first()["Valid"] == 1.0
    assert rows(tb.find_header_row(cells)) == [("f", "s", 2, 1.0, 1.0, 1.0)]
    assert rows(tb.header_values(cells)) == [("f", "s", 2, 0, ["id", "name", "sex"])]
    assert rows(tb.table_dims(cells)) == [("f", "s", 3, 3)]


RULES = [
    Rule(r".+血压\s*(\S*).*", r"\1", "BP"),
    Rule(r".+身高\s*(\S*).*", r"\1", "HEIGHT"),
]
REPORT = "姓名 张三\n\n血压 120/80\f体重 60kg"


def test_texts(spark):
    docs = spark.createDataFrame([("d", REPORT)], "doc_id string, text string")
    assert rows(tb.normalize_text(docs)) == [("d", "姓名 张三\n血压 120/80\n体重 60kg")]
    table = tb.documents_to_table(docs, RULES)
    assert table.data.columns == ["doc_id", "BP", "HEIGHT"]
    assert rows(table.data) == [("d", "120/80", None)]
    assert sorted(r[0] for r in rows(tb.line_heads(docs))) == ["体重", "姓名", "血压"]
    assert sorted(r[0] for r in rows(table.unmatched)) == ["体重", "姓名"]


def test_repeated_fields_get_numbered_names(spark):
    docs = spark.createDataFrame([("d", "a1 b2")], "doc_id string, text string")
    twice = spark.createDataFrame(
        [(r".*a(\d).*", r"\1", "V"), (r".*b(\d).*", r"\1", "v")],
        "Pattern string, Extract string, Fld string",
    )
    assert rows(tb.extract_fields(docs, twice)) == [("d", "1", "2")]
    assert tb.extract_fields(docs, twice).columns == ["doc_id", "V", "v_2"]


def test_head_patterns():
    rules = [
        Rule(r"医生甲医生.+?\n血压(.*)", "", "a"),
        Rule(r"^姓名", "", "b"),
        Rule(r".+??\n\n体重", "", "c"),
        Rule(r".+血压(.*)", "", "d"),
        Rule(r".+血压(.*)", "", "e"),
    ]
    assert head_patterns(rules) == [r"甲医生.+?\n血压(.*)", "^体重", "^血压(.*)"]


@pytest.mark.parametrize(
    ("text", "pattern", "extract", "expected"),
    [
        ("a b1 b2", r"b(\d)", r"[\1]", "a [1] b2"),
        ("line\nb1\nb2", r"b(\d)\n", r"<\1>", "line\n<1>b2"),
        ("abxx", r"x*$", "Y", "abY"),
        ("abb", r"b*", "Z", "Zabb"),
        ("x11y", r"(\d)\1", r"\0!", "x11!y"),
        ("cost 5", r"(\d)", r"$\10", "cost $50"),
        ("abc", "$", "!", "abc!"),
        ("c\\d", r"\\(.)", r"\\\1\1", "c\\dd"),
        ("", "^", "n", "n"),
        ("ab", "(?i)B|A", "_", "_b"),
    ],
)
def test_replace_first(spark, text, pattern, extract, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert rows(df.select(replace_first(F.col("t"), pattern, extract))) == [(expected,)]


@pytest.mark.parametrize(
    ("provider", "text", "expected"),
    [
        ("Ciming", "1.脂肪肝。建议复查。 2.血压偏高？请就医。", r"1.脂肪肝。\r\n2.血压偏高？"),
        ("Ciming", "1. 矫正视力不足，请验光。(2)龋齿", r"1.矫正视力不足\r\n(2)龋齿"),
        ("Ciming", "1.正常。3.家族史提示:父亲", r"1.正常。\r"),
        ("Ikang", "概述 【血脂】偏高：建议低脂\n饮食 【尿酸】正常", r"【血脂】偏高：\r\n【尿酸】正常"),
        ("Ikang", "无", ""),
        ("Meinian", "尊敬的张三★脂肪肝，建议复查\n1、说明\n（注）\n龋齿\n体检结果说明：略\n完", r"★脂肪肝，\r\n龋齿"),
        ("Ciming", None, ""),
        ("Ikang", None, ""),
        ("Meinian", None, ""),
    ],
)
def test_summaries(spark, provider, text, expected):
    df = spark.createDataFrame([(1, text, provider)], "id int, summ string, provider string")
    out = tb.simplify_summary(df, "summ", provider, output="short")
    assert out.first()["short"] == expected
    by_row = tb.simplify_summary(df, "B", provider_column="provider", output="short")
    assert by_row.first()["short"] == expected


def test_summary_overrides(spark):
    df = spark.createDataFrame([("A: one. two B: three",)], "t string")
    out = tb.simplify_summary(df, 1, "Ikang", beginner="[A-Z]:", ender="[.]", joiner=" / ")
    assert out.first()["summ"] == "A: one. / B: three"
    with pytest.raises(ValueError, match="provider"):
        tb.simplify_summary(df, "t", "Nobody")
    with pytest.raises(TypeError):
        tb.simplify_summary(df, "t", "Meinian", ender="x")
    with pytest.raises(ValueError, match="column"):
        resolve_column(df, "C")
