"""Shingle-set links, hard negatives, conversation repair and archives against their plain versions."""

import gzip
import random
from collections import Counter

import brute
import numpy as np
import pytest
from conftest import HARD
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablebind.llm import jaccard, negatives, queries, warc
from tablebind.llm.conversations import LAST, repair_conversations, solved
from tablebind.llm.jaccard import Classes, signatures, similar_documents
from tablebind.llm.negatives import hard_negatives


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def same(found, wanted):
    assert found == sorted(wanted, key=repr)


# ---- shingle sets


def changed(words, times, rng):
    words = list(words)
    for _ in range(times):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    return words


def families(seed=1):
    """Families of near copies about the threshold, sets of every small size, and a passage that
    texts of different families have in common."""
    rng = random.Random(seed)
    passage = [f"p{k}" for k in range(60)]
    out, doc = [], 1000
    for size in (5, 6, 7, 8, 9, 10, 12, 15, 20, 40, 80, 150, 400):
        base = [f"f{size}w{k}" for k in range(size)]
        for k in range(12):
            out.append((doc, " ".join(changed(base, k % 5 if size > 20 else k % 2, rng))))
            out.append((doc + 1, " ".join(base[: size - k // 3])))
            doc += 2
    for k in range(60):
        out.append((doc + k, " ".join([*(f"u{k}n{j}" for j in range(50)), *passage])))
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("rounds", [0, 2])
def test_jaccard(spark, hard, monkeypatch, rounds):
    monkeypatch.setattr(jaccard, "ROUNDS", rounds)
    data = HARD + families() + [(7, "FIVE words are one shingle"), (6, "five words are one shingle")]
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(5)
    found = similar_documents(docs)
    wanted = brute.jaccard(data)
    assert len({c for *_, c in wanted}) < len(data) - 50
    same(rows(found, "doc_id", "n_shingles", "component_id"), wanted)
    same(rows(similar_documents(hard), "doc_id", "n_shingles", "component_id"), brute.jaccard(HARD))


@pytest.mark.parametrize("percent", [60, 95])
def test_jaccard_other_thresholds(spark, percent):
    data = families(2)
    docs = spark.createDataFrame(data, "doc_id long, text string")
    found = similar_documents(docs, size=3, percent=percent)
    same(rows(found, "doc_id", "n_shingles", "component_id"), brute.jaccard(data, 3, percent))


def test_jaccard_crowded_buckets(spark, monkeypatch):
    """Signatures of crowded buckets take another way to the same links."""
    monkeypatch.setattr(jaccard, "_levels", lambda whole: np.full(jaccard.BUCKETS, 2, np.int8))
    data = families(3)
    found = similar_documents(spark.createDataFrame(data, "doc_id long, text string"))
    same(rows(found, "doc_id", "n_shingles", "component_id"), brute.jaccard(data))


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 90), st.integers(0, 22), st.integers(0, 22), st.integers(0, 2**32))
def test_similar_sets_share_a_signature(both, left, right, seed):
    rng = np.random.default_rng(seed)
    numbers = np.unique(rng.integers(0, 2**63, both + left + right).astype(np.uint64))
    rng.shuffle(numbers)
    a, b = np.sort(numbers[: both + left]), np.sort(np.concatenate([numbers[:both], numbers[both + left :]]))
    levels = rng.integers(0, 3, jaccard.BUCKETS).astype(np.int8)
    if 100 * both >= 80 * len(numbers):
        classes = Classes(80)
        assert set(signatures(a, classes, levels).tolist()) & set(signatures(b, classes, levels).tolist())


def test_jaccard_empty_and_long(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert rows(similar_documents(docs), "doc_id", "component_id") == []
    long = " ".join(f"w{k}" for k in range(800_000))  # 5 MB
    data = [(2, long), (1, long.replace("w77 ", "other ")), (3, "short"), (4, "w1 " * 900_000)]
    found = similar_documents(spark.createDataFrame(data, "doc_id long, text string"))
    assert rows(found, "doc_id", "component_id") == [(1, 1), (2, 1), (3, 3), (4, 4)]


def near_copies(n, seed=9):
    """Near copies of a text, up to nine of its words changed."""
    rng = random.Random(seed)
    base = [f"w{k}" for k in range(150)]
    return [(k, " ".join(changed(base, rng.randrange(10), rng))) for k in range(n)]


@pytest.mark.parametrize("n, some", [(150, 2048), (600, 2048), (600, 30)])
def test_jaccard_near_copies(spark, monkeypatch, n, some):
    """The pairs that are looked at as whole sets grow with a group of near copies, not its square."""
    looked_at = []
    verified = jaccard._verified

    def counted(pairs, *rest):
        looked_at.append(pairs.count())
        return verified(pairs, *rest)

    monkeypatch.setattr(jaccard, "_verified", counted)
    monkeypatch.setattr(jaccard, "SOME", some)
    data = near_copies(n)
    found = similar_documents(spark.createDataFrame(data, "doc_id long, text string"))
    wanted = brute.jaccard(data)
    assert Counter(c for *_, c in wanted).most_common(1)[0][1] > n / 4
    same(rows(found, "doc_id", "n_shingles", "component_id"), wanted)
    assert sum(looked_at) < 5 * n


def test_jaccard_query(spark, sf_dir, documents):
    wanted = brute.jaccard(documents[1])
    assert any(d != c for d, _, c in wanted)
    same(rows(queries.similar(spark, sf_dir), "*"), wanted)


# ---- hard negatives


def vector_rows():
    rng = random.Random(4)
    out = [(k, rng.randrange(3), [rng.uniform(-1, 1) for _ in range(6)]) for k in range(1, 400)]
    out += [(1000 + k, k % 2, [0.5] * 6) for k in range(150)]  # equal vectors, ties by id
    out += [(2000 + k, 0, [1.0, 0.0, 0.0, 0.0, 0.0, k / 256]) for k in range(100)]
    out += [
        (300, None, [1.0] * 6), (500, 1, None), (600, 1, [1.0, None, 0.0]), (700, 1, [float("nan")] * 6),
        (800, 1, [float("inf")] * 6), (None, 1, [1.0] * 6), (900, 2, []), (901, 2, [1.0]), (5, 0, [0.1] * 6),
        (5, 0, [0.1] * 6), (-100, 1, [0.25] * 6), (-7, 0, [-0.25] * 9), (4200, 77, [1.0] * 6),
    ]
    return out


@pytest.mark.parametrize("tile_rows", [16, 200, None])
def test_negatives(spark, tile_rows):
    data = vector_rows()
    df = spark.createDataFrame(data, "vec_id long, label int, embedding array<double>").repartition(3)
    df = df.withColumns({"id": F.lit("clash"), "v": F.lit(1), "tile": F.lit(2)})
    found = hard_negatives(df, tile_rows=tile_rows)
    wanted = brute.negatives(data)
    assert len(wanted) > 50
    same(rows(found, "*"), wanted)


def test_negatives_at_once(spark, monkeypatch):
    monkeypatch.setattr(negatives, "ANCHORS", 2)
    monkeypatch.setattr(negatives, "AT_ONCE", 1)
    data = vector_rows()
    df = spark.createDataFrame(data, "vec_id long, label int, embedding array<double>")
    same(rows(hard_negatives(df, tile_rows=64), "*"), brute.negatives(data))


def test_negatives_of_large_numbers(spark):
    data = [(100 * k, k % 2, [float(2**30 + k), -1.0, k / 3]) for k in range(12)] + [(1, 1, [1e300, 0.0, 0.0])]
    df = spark.createDataFrame(data, "vec_id long, label int, embedding array<double>")
    found = hard_negatives(df, factor=1)
    scale = [(i, c, [x / 256 for x in v]) for i, c, v in data[:-1]]
    same(rows(found, "*"), brute.negatives(scale))


def test_negatives_of_none(spark):
    schema = "vec_id long, label int, embedding array<float>"
    assert hard_negatives(spark.createDataFrame([], schema)).isEmpty()
    assert hard_negatives(spark.createDataFrame([(100, 1, [1.0])], schema)).isEmpty()
    assert hard_negatives(spark.createDataFrame([(100, None, [1.0]), (None, 1, None)], schema)).isEmpty()


def test_negatives_query(spark, sf_dir):
    data = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "label", "embedding").collect()
    label = lambda r: r[1] if r[1] is None or r[0] is None or r[0] % 7 else (r[1] + 1) % 10
    wanted = brute.negatives([(r[0], label(r), r[2]) for r in data])
    assert wanted
    same(rows(queries.negatives(spark, sf_dir), "*"), wanted)


# ---- conversations


def talk_rows():
    rng = random.Random(5)
    texts = ["Yes.", "no", "Why?", "", " \t", None, "So it is!", "a\nb", "  end. ", "x" * 30 + "."]
    roles = ["user", "assistant", "system", "tool", None, "", "u", "assistant", "user"]
    out = []
    for conv in range(1, 260):
        for turn in range(rng.randrange(1, 9)):
            out.append((conv, turn if rng.random() < 0.9 else rng.choice([None, 3, 2**40, -5]), rng.choice(roles), rng.choice(texts)))
    for conv in range(300, 330):
        out += [(conv, k, ("user", "assistant")[k % 2], f"turn {k}.") for k in range(300)]
    out += [(None, 1, "user", "Hello."), (None, None, None, None), (None, 1, "user", "Hello.")]
    return out


@pytest.mark.parametrize("part_rows", [100_000, 4])
def test_conversations(spark, part_rows):
    data = talk_rows()
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string").repartition(4)
    df = df.withColumns({"conv": F.lit("clash"), "fault": F.lit(1), "before": F.lit(None).cast("string")})
    found = repair_conversations(df, test_faults=True, part_rows=part_rows)
    wanted = brute.conversations(data)
    assert any(w[-1] == brute.sha("") and w[-3] == 0 for w in wanted)  # nothing left
    same(rows(found, "*"), wanted)


def test_conversations_as_they_are(spark):
    data = [(1, 0, "system", "S."), (1, 1, "user", "U?"), (1, 2, "assistant", "A."), (2, 0, "user", "U.")]
    data += [(3, k, "user" if k % 2 else "system", "word " * 1_000_000 + ".") for k in range(2)]  # 5 MB texts
    df = spark.createDataFrame(data, "conv_id int, turn int, role string, text string")
    found = {r.conv_id: r for r in repair_conversations(df).collect()}
    assert (found[1].cost, found[1].audit) == (0, "KKK")
    assert found[1].repaired_sha256 == brute.sha("system:S.\nuser:U?\nassistant:A.")
    assert (found[2].cost, found[2].audit) == (2, "D")
    assert (found[3].cost, found[3].audit, found[3].truncated) == (2, "RR", 0)
    empty = repair_conversations(df.where("false"), test_faults=True)
    assert empty.isEmpty()
    assert empty.schema["conv_id"].dataType.simpleString() == "int"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["user.", "user", "assistant.", "assistant", "system.", "tool.", "tool", ""]), max_size=7))
def test_repair_automaton(kinds):
    """Costs and audits of the automaton against a search over single conversations."""
    conversation, letters = [], []
    for k, kind in enumerate(kinds):
        role = kind.rstrip(".")
        conversation.append((k, role, f"text {k}{'.' if kind.endswith('.') else ''}" if kind else ""))
        letter = role[:1] if role[:1] in ("s", "u", "a") else "o"
        letters.append("d" if not kind else letter if kind.endswith(".") else letter.upper())
    nodes = [LAST]
    for letter in reversed(letters):
        nodes.append(solved(letter, nodes[-1]))
    at, state, audit = len(letters), 0, ""
    while edit := nodes[at][state][1]:
        audit += edit
        state, at = nodes[at][state][2], at - (edit != "I")
    *_, cost, wanted, _ = brute.repair(conversation)
    assert (nodes[-1][0][0], audit) == (cost, wanted)


def test_conversations_query(spark, sf_dir):
    data = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    wanted = brute.conversations([tuple(r) for r in data])
    assert sum(w[-3] > 0 for w in wanted) > 5
    same(rows(queries.conversations(spark, sf_dir), "*"), wanted)


# ---- archives as others write them

DESCRIBED = {
    1: b"1 0 Some Crawler\nURL IP-address Archive-date Content-type Archive-length\n",
    2: b"2 0 Some Crawler\nURL IP-address Archive-date Content-type Result-code Checksum Location Offset "
    b"Filename Archive-length\n",
}


def arc_line(version, url, date, mime, body):
    if version == 1:
        return b"%s 10.0.0.1 %s %s %d\n" % (url, date, mime, len(body)) + body + b"\n"
    return b"%s 10.0.0.1 %s %s 200 abc - 17 x.arc %d\n" % (url, date, mime, len(body)) + body + b"\n"


def arc_file(version, records):
    opening = arc_line(version, b"filedesc://x.arc", b"19990101000000", b"text/plain", DESCRIBED[version])
    return opening + b"".join(arc_line(version, *r) for r in records)


PAGES = [
    (b"http://a.org/ x y", b"19990102030405", b"text/html", b"HTTP/1.0 200 OK\r\nA: b\r\n\r\n<p>\nhi"),
    (b"http://b.org/", b"19990102", b"text/html", b"no head\r\n\r\nhere"),
    (b"dns:c.org", b"19990102030406", b"text/dns", b""),
]


@pytest.mark.parametrize("version", [1, 2])
def test_archives_of_both_versions(spark, tmp_path, version):
    source = arc_file(version, PAGES)
    folder = tmp_path / "arc"
    folder.mkdir()
    (folder / "plain.arc").write_bytes(source.replace(b" 200 abc", b" 404 abc"))
    members = [source[:100], source[100:]]
    (folder / "zipped.arc.gz").write_bytes(b"".join(map(gzip.compress, members)))
    found = warc.read_arc(spark, str(folder), payloads=True).collect()
    assert len(found) == 6
    for name in ("plain.arc", "zipped.arc.gz"):
        mine = sorted((r for r in found if r.file.endswith(name)), key=lambda r: r.n)
        assert [r.url.encode() for r in mine] == [p[0] for p in PAGES]
        assert [r.date.encode() for r in mine] == [p[1] for p in PAGES]
        assert [bytes(r.payload) for r in mine] == [b"<p>\nhi", b"no head\r\n\r\nhere", b""]
        assert [r.size for r in mine] == [6, 15, 0]
    assert warc.damaged_records(spark, str(folder)).isEmpty()
    warc.convert_arc(spark, str(folder), str(tmp_path / "warc"))
    read = warc.read_warc(spark, str(tmp_path / "warc")).collect()
    assert sorted(r.type for r in read) == ["resource"] * 2 + ["response"] + ["revisit"] * 3


def test_damaged_archives(spark, tmp_path):
    good = arc_file(2, PAGES)
    last = good.rindex(b"dns:c.org")
    files = {
        "cut.arc": good + arc_line(2, b"http://d.org/", b"2000", b"text/html", b"x" * 500)[:100],
        "length.arc": good.replace(b"x.arc 15\n", b"x.arc 5\n"),
        "long.arc": good.replace(b"x.arc 15\n", b"x.arc 99999\n"),
        "noise.arc": good[:last] + b"\x00\xff noise\nand more 12\n" + good[last:],
        "empty.arc": b"",
        "member.arc.gz": gzip.compress(good) + gzip.compress(good)[:40],
        "text.arc": b"nothing of this is an archive",
    }
    folder = tmp_path / "arc"
    folder.mkdir()
    for name, data in files.items():
        (folder / name).write_bytes(data)
    found = {}
    for r in warc.read_arc(spark, str(folder), payloads=False).collect():
        found.setdefault(r.file.rpartition("/")[2], []).append(r.url)
    a, b, c = (p[0].decode() for p in PAGES)
    assert found.pop("cut.arc") == [a, b, c] == found.pop("noise.arc")
    assert found.pop("length.arc") == [a, c] == found.pop("long.arc")
    assert found.pop("member.arc.gz")[:3] == [a, b, c]
    assert not found
    damaged = {r.file.rpartition("/")[2]: (r.offset, r.reason) for r in warc.damaged_records(spark, str(folder)).collect()}
    assert damaged["cut.arc"] == (len(good), "a record of 500 bytes is cut off")
    assert damaged["noise.arc"] == (last, "no header line")
    assert damaged["length.arc"][1] == "no line end after 5 bytes"
    assert damaged["text.arc"] == (0, "no header line")
    assert "empty.arc" not in damaged
    warc.convert_arc(spark, str(folder), str(tmp_path / "warc"))
    assert warc.read_warc(spark, str(tmp_path / "warc")).count() >= 13


def test_archive_of_long_pages(spark, tmp_path, monkeypatch):
    """Pages of 30 MB are cut into files of two records, and read as a stream."""
    monkeypatch.setattr(warc, "FILE_BYTES", 40 << 20)
    data = [(k, f"http://x/{k}", f"<p>{k}</p>" + "abc 123 " * (4 << 20 if k < 3 else 10)) for k in range(6)]
    pages = spark.createDataFrame(data, "page_id long, url string, html string").coalesce(2)
    found = warc.archived(pages, folder=str(tmp_path / "out"))
    same(
        rows(found, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"),
        brute.warc([(k, html) for k, _, html in data]),
    )
    assert len(list((tmp_path / "out" / "arc").glob("part-*"))) > 3
