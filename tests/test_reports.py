import pytest

import tablebind as tb
from tablebind.operators.reports import render_head, resolve_alignment, resolve_heading


def test_heading_spans():
    heading = resolve_heading(
        [["Inbound", None, "Outbound", None, "Port"], ["Ships", "Tons", "Ships", "Tons", None]], 5
    )
    html = render_head(heading, resolve_alignment(None, 5))
    assert html == (
        " <thead>\n"
        "  <tr>\n"
        '   <th colspan="2" style="text-align:center;"> Inbound </th>\n'
        '   <th colspan="2" style="text-align:center;"> Outbound </th>\n'
        '   <th rowspan="2" style="text-align:center;"> Port </th>\n'
        "  </tr>\n"
        "  <tr>\n"
        '   <th style="text-align:left;"> Ships </th>\n'
        '   <th style="text-align:center;"> Tons </th>\n'
        '   <th style="text-align:center;"> Ships </th>\n'
        '   <th style="text-align:center;"> Tons </th>\n'
        "  </tr>\n"
        " </thead>\n"
    )


def test_heading_blank_column_and_blocks():
    heading = resolve_heading([[None, "A", "="], [None, "|", "|"]], 3)
    html = render_head(heading, ["left"] * 3)
    assert '<th rowspan="2" style="text-align:left;">&nbsp;&nbsp;&nbsp;</th>' in html
    assert '<th rowspan="2" colspan="2" style="text-align:center;"> A </th>' in html
    # a head below the span keeps its own cell, so only rows are joined
    heading = resolve_heading([["A", "="], ["|", "B"]], 2)
    html = render_head(heading, ["left"] * 2)
    assert '<th rowspan="2" style="text-align:center;"> A </th>' in html
    assert '<th style="text-align:left;"> B </th>' in html


def test_heading_and_alignment_are_checked():
    assert resolve_heading(["a", None, "b"], 3) == [["a", None, "b"]]
    assert resolve_heading([["a", "b", None], ["c", "d", "e"]], 3)[0] == ["a", "b", "="]
    with pytest.raises(ValueError, match="columns"):
        resolve_heading(["a"], 2)
    assert resolve_alignment(["r", "L"], 4) == ["right", "left", "left", "left"]
    assert resolve_alignment(["r", "c", "l"], 2) == ["right", "center"]
    with pytest.raises(ValueError, match="align"):
        resolve_alignment("x", 1)


def test_html_table(spark):
    df = spark.createDataFrame(
        [("g", 1, "x", '<a & "b">'), ("g", 2, "x", None), ("g", 3, "y", "z")],
        "g string, i int, p string, q string",
    )
    out = tb.html_tables(
        df, "g", "i", ["p", "q"], ["P", "Q"], foot_rows=1, blank="p", caption="T", width="50%"
    ).collect()
    assert [(r["g"], r["PART"]) for r in out] == [("g", 0)]
    assert out[0]["html"] == (
        "<table width=50%>\n<caption>T</caption>\n <thead>\n  <tr>\n"
        '   <th style="text-align:left;"> P </th>\n'
        '   <th style="text-align:center;"> Q </th>\n'
        "  </tr>\n </thead>\n<tbody>\n"
        '  <tr>\n   <td style="text-align:left;"> x </td>\n'
        '   <td style="text-align:center;"> &lt;a &amp; &quot;b&quot;&gt; </td>\n  </tr>\n'
        '  <tr>\n   <td style="text-align:left;">  </td>\n'
        '   <td style="text-align:center;"> NA </td>\n  </tr>\n'
        "</tbody>\n<tfoot>\n"
        '  <tr>\n   <td style="text-align:left;"> y </td>\n'
        '   <td style="text-align:center;"> z </td>\n  </tr>\n'
        "</tfoot>\n</table>"
    )
    with pytest.raises(ValueError, match="foot"):
        tb.html_tables(df, "g", "i", foot_rows=3)


def test_one_html_table_without_groups(spark):
    df = spark.createDataFrame([(2, "b"), (1, "a"), (3, None)], "i int, v string")
    whole = tb.html_tables(df, (), "i", ["v"]).collect()
    assert [r["PART"] for r in whole] == [0]
    assert [line.strip() for line in whole[0]["html"].splitlines() if "<td" in line] == [
        '<td style="text-align:left;"> a </td>',
        '<td style="text-align:left;"> b </td>',
        '<td style="text-align:left;"> NA </td>',
    ]
    pieces = tb.html_tables(df, [], "i", ["v"], part_rows=1).orderBy("PART").collect()
    assert "".join(r["html"] for r in pieces) == whole[0]["html"]
