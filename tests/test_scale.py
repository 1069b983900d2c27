"""The paths for large groups give what a single ordered pass gives."""

import pytest
from pyspark.sql import functions as F

import tablebind as tb
from tablebind.plans.ordered import POSITION, SIZE, place_rows, split_by_size


@pytest.fixture(scope="module")
def skewed(spark):
    """One key with a third of the rows, some null keys, values with gaps."""
    i = F.col("id")
    return spark.range(3000).repartition(7).select(
        F.when(i % 3 == 0, "hot").when(i % 50 == 1, None).otherwise(F.concat(F.lit("k"), i % 97)).alias("k"),
        ((i * 7919) % 3001).alias("n"),
        F.when(i % 5 == 0, "").when(i % 7 == 0, "NA").otherwise((i % 11).cast("string")).alias("a"),
        F.when(i % 4 != 0, i % 3).alias("b"),
    ).persist()


def by_key(df):
    groups = {}
    for r in df.collect():
        groups.setdefault(r["k"], []).append(r)
    return {k: sorted(rs, key=lambda r: r["n"]) for k, rs in groups.items()}


@pytest.mark.parametrize("limit", [5, 40, 100_000])
def test_positions(skewed, limit):
    out = by_key(place_rows(skewed, ["k"], ["n"], limit=limit))
    expected = by_key(skewed)
    assert out.keys() == expected.keys()
    for k, rows in out.items():
        assert [r[POSITION] for r in rows] == list(range(len(rows)))
        assert {r[SIZE] for r in rows} == {len(expected[k])}


@pytest.mark.parametrize("limit", [5, 100_000])
@pytest.mark.parametrize("keys", [["k"], []])
def test_place_rows(skewed, limit, keys):
    out = place_rows(skewed, keys, ["n"], {"a": "pa", "b": "pb"}, limit)
    groups = by_key(out) if keys else {None: sorted(out.collect(), key=lambda r: r["n"])}
    assert sum(map(len, groups.values())) == 3000
    for rows in groups.values():
        assert [(r["pa"], r["pb"]) for r in rows] == [(None, None)] + [
            (r["a"], r["b"]) for r in rows[:-1]
        ]


def test_split_by_size_is_whole(skewed):
    parts = split_by_size(skewed, ["k"], 30)
    small, large = parts.usual, parts.oversized
    assert {r[0] for r in large.select("k").distinct().collect()} >= {"hot", None}
    assert small.count() + large.count() == 3000
    assert parts.oversized_rows == large.count()
    assert split_by_size(skewed, ["k"], 3000).oversized is None
    assert split_by_size(skewed, [], 10).usual is None


def merged_by_hand(rows):
    def missing(v):
        return v is None or v in ("", "NA")

    texts = [r["a"] for r in rows if not missing(r["a"])]
    firsts = [r["b"] for r in rows if r["b"] is not None]
    if len(rows) == 1:
        return rows[0]["a"], rows[0]["b"]
    return ";".join(texts) or None, firsts[0] if firsts else None


@pytest.mark.parametrize("part_rows", [7, 100_000])
def test_bind_rows(skewed, part_rows):
    out = tb.bind_rows(skewed, "k", "n", {"a": True, "b": False}, part_rows)
    parts = {}
    for r in out.orderBy("k", "PART").collect():
        parts.setdefault(r["k"], []).append(r)
    expected = {k: v for k, v in by_key(skewed).items() if k is not None}
    assert parts.keys() == expected.keys()
    for k, rows in parts.items():
        size = len(expected[k])
        assert [r["PART"] for r in rows] == list(range(-(-size // part_rows)))
        text = ";".join(r["a"] for r in rows if r["a"] is not None) if size > 1 else rows[0]["a"]
        assert (text or None if size > 1 else text, rows[0]["b"]) == merged_by_hand(expected[k])
        assert all(r["b"] is None for r in rows[1:])


def test_result_does_not_depend_on_partitioning(skewed):
    one = tb.bind_rows(skewed.coalesce(1), "k", "n", {"a": True, "b": False}, 7)
    many = tb.bind_rows(skewed.repartition(13), "k", "n", {"a": True, "b": False}, 7)
    assert one.exceptAll(many).isEmpty()
    assert many.exceptAll(one).isEmpty()


@pytest.mark.parametrize("group_rows", [7, 100_000])
def test_blank_repeats(spark, skewed, group_rows):
    for keys in ([], ["k"]):
        out = tb.blank_repeats(skewed, ["b"], "n", keys, group_rows)
        groups = by_key(skewed) if keys else {None: sorted(skewed.collect(), key=lambda r: r["n"])}
        expected = {}
        for rows in groups.values():
            for before, r in zip([None, *rows], rows):
                same = before is not None and r["b"] is not None and r["b"] == before["b"]
                shown = "" if same else None if r["b"] is None else str(r["b"])
                expected[r["n"]] = shown
        assert {r["n"]: r["b"] for r in out.collect()} == expected


def test_blank_repeats_golden(spark):
    values = ["a", "a", "b", None, None, "b"]
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    out = [r["v"] for r in tb.blank_repeats(df, "v", "i").orderBy("i").collect()]
    assert out == ["a", "", "b", None, None, "b"]


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_split_footer(skewed, keys):
    df = skewed.where("k = 'hot' or n % 97 < 60")
    split = tb.split_footer(df, 1, ["n"], keys)
    groups = by_key(df) if keys else {None: sorted(df.collect(), key=lambda r: r["n"])}
    assert sorted(r["n"] for r in split.foot.collect()) == sorted(g[-1]["n"] for g in groups.values())
    assert split.body.count() + split.foot.count() == df.count()
    with pytest.raises(ValueError, match="whole"):
        tb.split_footer(df, df.count(), ["n"], keys)


@pytest.mark.parametrize("foot_rows", [0, 1])
def test_html_pieces_make_the_same_tables(skewed, foot_rows):
    df = skewed.where("k = 'hot' or n % 97 < 60").withColumn("g", F.coalesce("k", F.lit("none")))
    options = {"columns": ["n", "a", "b"], "blank": ["b"], "foot_rows": foot_rows}
    whole = {r["g"]: r["html"] for r in tb.html_tables(df, "g", "n", **options).collect()}
    pieces = {}
    cut = tb.html_tables(df, "g", "n", part_rows=10, **options)
    for r in cut.orderBy("g", "PART").collect():
        pieces[r["g"]] = pieces.get(r["g"], "") + r["html"]
    assert cut.where("g = 'hot'").count() > 10
    assert pieces == whole


def test_long_texts_make_more_parts(spark):
    """40 rows of 10 kB weigh 400; at 100 a part that is ten rows in each of four."""
    i = F.col("id")
    df = spark.range(41).select(
        F.when(i < 40, 1).otherwise(2).alias("k"), i.alias("n"),
        F.repeat(F.char(i + 48), F.lit(10 * 1024)).alias("t"),
    )
    out = tb.bind_rows(df, "k", "n", {"t": True}, 100).orderBy("k", "PART").collect()
    assert [(r["k"], r["PART"], len(r["t"])) for r in out] == [
        (1, 0, 102409), (1, 1, 102409), (1, 2, 102409), (1, 3, 102409), (2, 0, 10240),
    ]
    whole = tb.bind_rows(df, "k", "n", {"t": True}).where("k = 1").first()["t"]
    assert ";".join(r["t"] for r in out[:4]) == whole
