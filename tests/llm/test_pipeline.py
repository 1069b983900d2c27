"""The stages of the corpus pipeline against plain versions of them."""

import zlib

import brute
import numpy as np
import public_tokenizers
import pytest
from conftest import HARD, hard_docs
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline


def texts(df):
    return sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()), key=repr)


def without_passages(docs, items):
    """Documents less the words of passages, as lists of alphanumeric words."""
    windows = {}
    for _, text in items:
        words = brute.ALNUM.findall(brute.low(text))
        for k in range(max(1, len(words) - 9) if words else 0):
            windows.setdefault(len(words[k : k + 10]), set()).add(tuple(words[k : k + 10]))
    out = []
    for key, text in docs:
        words = brute.ALNUM.findall(brute.low(text))
        hit = {
            k + j
            for n, known in windows.items()
            for k in range(len(words) - n + 1)
            if tuple(words[k : k + n]) in known
            for j in range(n)
        }
        left = [w for k, w in enumerate(words) if k not in hit]
        if left or not hit:
            out.append((key, left))
    return sorted(out, key=repr)


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


@pytest.fixture(params=["hard", "documents"])
def case(request, spark, sf_dir, documents):
    if request.param == "hard":
        return hard_docs(spark), HARD
    return documents


def test_stage_quality(spark, sf_dir, case):
    docs, data = case
    out = stage("quality rules")(spark, docs, sf_dir)
    assert out.columns == docs.columns
    # No line is in so many documents here that it would go.
    assert texts(out) == sorted(((k, t) for k, t in data if not brute.quality_base(t)[-1]), key=repr)


def test_stage_quality_removes_shared_lines(spark, sf_dir):
    """A line of more than a hundred texts of a source goes; in fewer, or of several sources, it stays."""
    menu, few = "home about contact and a longer menu line of this source", "a line of only ninety texts here"
    rows = []
    for k in range(150):
        own = " ".join(f"word{k}x{j}" for j in range(40))
        lines = [menu, own] + [few] * (k < 90) + [f"line of several sources {k % 2}"]
        rows.append((k, "\n".join(lines), f"s{0 if k < 150 else 1}"))
    rows += [(1000 + k, f"{menu}\n" + " ".join(f"other{k}x{j}" for j in range(30)), f"t{k % 3}") for k in range(150)]
    rows += [(2000 + k, menu + "\nx", "s0") for k in range(3)]  # little else: depleted
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    docs = docs.withColumn("n_chars", F.length("text").cast("long"))
    out = stage("quality rules")(spark, docs, sf_dir)
    held = {}
    for _, text, source in rows:
        for line in set(text.split("\n")):
            held[source, line] = held.get((source, line), 0) + 1
    wanted = []
    for key, text, source in rows:
        left = "\n".join(x for x in text.split("\n") if held[source, x] <= 100)
        if key < 2000:
            wanted.append((key, left))
    assert texts(out) == sorted(wanted, key=repr)
    assert out.where("n_chars <> length(text)").isEmpty()
    assert all(menu not in t for k, t in texts(out) if k < 1000) and few in dict(texts(out))[1]


def test_stage_packing(spark, sf_dir, case):
    """Every id of every document lies in one piece, at its place."""
    docs, data = case
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    found = stage("packing")(spark, docs, sf_dir).collect()
    wanted, pieces = [], {}
    for key, text in data:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        for start in range(0, len(ids), 4096):
            part = np.array(ids[start : start + 4096], "<u4").tobytes()
            wanted.append((key, start, len(part) // 4, zlib.crc32(part), len(ids)))
    assert sorted((tuple(r)[:5] for r in found), key=repr) == sorted(wanted, key=repr)
    for r in found:
        pieces.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in pieces.values():
        held.sort()
        assert held[0][0] == 0 and sum(n for _, n in held) <= 4096
        assert all(a + n == b for (a, n), (b, _) in zip(held, held[1:]))


def test_stage_dedup(spark, sf_dir, case):
    docs, data = case
    out = stage("SimHash near-dedup")(spark, docs, sf_dir)
    assert out.columns == docs.columns
    groups = {}
    for (key, text), (_, _, c) in zip(data, brute.simhash(data), strict=True):
        groups.setdefault((c, brute.fingerprint(text) if c is None else 0), []).append((key is None, key, text))
    kept = [min(g, key=lambda r: (r[0], r[1] or 0)) for g in groups.values()]
    assert sorted(k for _, k, _ in kept if k is not None) == [k for k, _ in sorted(r for r in texts(out) if r[0] is not None)]
    assert out.count() == len(kept)


def test_stage_decontamination(spark, sf_dir, case):
    docs, data = case
    items = [(r[0], r[1]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    out = stage("benchmark decontamination")(spark, docs, sf_dir)
    assert out.columns == docs.columns
    found = sorted(((k, brute.ALNUM.findall(brute.low(t))) for k, t in texts(out)), key=repr)
    assert found == without_passages(data, items)


def test_stage_secrets(spark, sf_dir, case):
    docs, data = case
    out = stage("secret scans")(spark, docs, sf_dir)
    assert out.columns == docs.columns
    found = texts(out)
    assert len(found) == len(data)
    assert not any(brute.base_spans(t.replace("[SECRET]", " ") if t else t) for _, t in found)
    clean = [(k, t) for k, t in data if not brute.base_spans(t) and k not in (14, 16, 21)]
    assert all(c in found for c in clean)


def test_run(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    sums = out.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    assert sums.where("n > 4096").isEmpty()
    assert out.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("d")).where("n <> d").isEmpty()
