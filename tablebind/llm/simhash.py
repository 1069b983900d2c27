"""Near duplicates by SimHash, found through an inverted index over byte positions."""

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablebind.functions.names import col
from tablebind.llm.common import id_text, lower_words, map_batches, texts
from tablebind.llm.components import components
from tablebind.plans.checkpoints import checkpointed, stored
from tablebind.plans.joins import lookup

#: Shingles whose bits are counted at once.
COUNTED = 65_536
#: Fingerprints with one posting key that one task compares; larger groups are split.
GROUP = 4096


def fingerprint(text: bytes, size: int) -> int:
    """The SimHash of a text's word shingles; 0 without words."""
    from xxhash import xxh64_digest

    words = lower_words(text)
    if not words:
        return 0
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    if len(words) > size:
        starts, ends = (ends - lengths)[: 1 - size or None], ends[size - 1 :]
        pairs = zip(starts.tolist(), ends.tolist(), strict=True)
        hashes = b"".join([xxh64_digest(line[a:b], 42) for a, b in pairs])
    else:
        hashes = xxh64_digest(line, 42)
    bits, n = np.zeros(64, np.int64), len(hashes) // 8
    rows = np.frombuffer(hashes, np.uint8).reshape(n, 8)
    for at in range(0, n, COUNTED):
        bits += np.unpackbits(rows[at : at + COUNTED], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(bits * 2 > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    def hashed(batches):
        for batch in batches:
            values = [fingerprint(x, size) for x in texts(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("row_hash"), pa.array(values, pa.int64())],
                ["id", "row_hash", "f"],
            )

    source = id_text(docs, id_col, text_col).withColumn(
        "row_hash", F.xxhash64(F.coalesce("text", F.lit("")))
    )
    return map_batches(source, hashed, "id long, row_hash long, f long")


def _choices(bits: int) -> list[tuple[int, ...]]:
    return list(combinations(range(7), 7 - bits))


def postings(prints: DataFrame, bits: int) -> DataFrame:
    """``prints`` (f) under every choice of byte positions that a link must share.

    Two fingerprints within ``bits`` bits share at least 8 - bits byte positions, so at least one
    fewer among the first seven. The last byte of a key names the choice.
    """
    masks = [sum(0xFF << (8 * (7 - p)) for p in chosen) for chosen in _choices(bits)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keys = F.array(
        *[
            F.col("f").bitwiseAND(F.lit(m).cast("long")).bitwiseOR(F.lit(k).cast("long"))
            for k, m in enumerate(signed)
        ]
    )
    return prints.select(F.explode(keys).alias("key"), "f")


def _spread(listed: DataFrame, bits: int, group: int) -> DataFrame:
    """Postings with a ``part``: groups above ``group`` are split by one more byte.

    The fingerprints of a group share one byte position fewer than a link must, so linked ones
    share another position as well: each entry goes to a part for every other position and its
    byte there. Only a part that is still above ``group`` becomes pairs of blocks.
    """
    large = checkpointed(
        listed.groupBy("key").count().where(F.col("count") > group).select("key", F.lit(True).alias("large"))
    )
    if large.isEmpty():
        return listed.withColumn("part", F.lit(0).cast("long"))
    others = F.array(*[F.array(*[F.lit(p) for p in range(8) if p not in c]) for c in _choices(bits)])
    mine = others[F.col("key").bitwiseAND(F.lit(0xFF).cast("long")).cast("int")]
    parts = (
        lookup(listed, large, ["key"], "left")
        .withColumn("p", F.explode(F.when(F.col("large"), mine).otherwise(F.array(F.lit(-1)))))
        .withColumn(
            "part",
            F.when(F.col("p") < 0, F.lit(0).cast("long")).otherwise(
                F.expr("1 + p * 256L + (shiftrightunsigned(f, (7 - p) * 8) & 255L)")
            ),
        )
        .select("key", "f", "part")
    )
    crowded = parts.where("part > 0").groupBy("key", "part").count().where(F.col("count") > group)
    crowded = checkpointed(crowded)
    if crowded.isEmpty():
        return parts
    blocks = F.ceil(F.coalesce("count", F.lit(1)) / group).cast("long")
    other = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    return (
        lookup(parts, crowded, ["key", "part"], "left")
        .withColumn("blocks", blocks)
        .withColumn("mine", F.pmod(F.xxhash64("f"), F.col("blocks")))
        .withColumn("other", F.explode(other))
        .select("key", "f", F.expr("part + 4096L * (least(mine, other) * blocks + greatest(mine, other))").alias("part"))
    )


def _group_links(group: np.ndarray, bits: int, out: list[tuple[int, int]]) -> None:
    """Links that connect what is connected within a group: each member to where it was met.

    A pair is kept if it shares the guaranteed number of bytes, and then if its bits agree.
    """
    left = group
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            this = queue.pop()
            differ = left ^ this
            shared = 8 - np.count_nonzero(differ.view(np.uint8).reshape(-1, 8), axis=1)
            linked = shared >= 8 - bits
            linked[linked] = np.bitwise_count(differ[linked]) <= bits
            for other in left[linked].tolist():
                out.append((int(this), other))
            queue.extend(left[linked])
            left = left[~linked]


def _links(batches, bits: int):
    """Links out of postings sorted by key and part; a group may go on in the next batch."""
    rest = np.zeros((3, 0), np.int64)

    def linked(rows: np.ndarray):
        keys, parts, prints = rows
        edges = np.flatnonzero((np.diff(keys) != 0) | (np.diff(parts) != 0)) + 1
        bounds = np.concatenate([[0], edges, [len(keys)]])
        sizes = np.diff(bounds)
        prints, out = prints.view(np.uint64), []
        twos = bounds[:-1][sizes == 2]  # most groups that have any pair
        differ = prints[twos] ^ prints[twos + 1]
        shared = 8 - np.count_nonzero(differ.view(np.uint8).reshape(-1, 8), axis=1)
        for k in twos[(shared >= 8 - bits) & (np.bitwise_count(differ) <= bits)].tolist():
            out.append((int(prints[k]), int(prints[k + 1])))
        for k in np.flatnonzero(sizes > 2).tolist():
            _group_links(prints[bounds[k] : bounds[k + 1]], bits, out)
        pairs = np.array(out, np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    for batch in batches:
        rows = np.stack([batch.column(n).to_numpy() for n in ("key", "part", "f")])
        rows = np.concatenate([rest, rows], axis=1)
        same = (rows[0] == rows[0, -1]) & (rows[1] == rows[1, -1])
        cut = int(same.argmax())  # sorted: where the last group begins
        rest = rows[:, cut:]
        if cut:
            yield linked(np.ascontiguousarray(rows[:, :cut]))
    if rest.shape[1]:
        yield linked(np.ascontiguousarray(rest))


def links(prints: DataFrame, bits: int, group: int = GROUP) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints ``f`` within ``bits`` bits."""
    listed = _spread(postings(prints, bits), bits, group)
    ordered = listed.repartition("key", "part").sortWithinPartitions("key", "part")
    return ordered.mapInArrow(lambda batches: _links(batches, bits), "a long, b long")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 4,
    bits: int = 4,
    group: int = GROUP,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id, component (a
    number of its own for each component) and row_hash (of the text).

    Equal fingerprints are one entry of the index, so copies never meet as pairs. An entry is
    posted under every choice of 7 - ``bits`` of the first seven byte positions. A link shares
    8 - ``bits`` or more of all eight, so none is missed; pairs that meet under a key are tallied by
    the bytes they share, and those that reach that number are verified by their bits. That
    happens inside a task, which returns only links that connect; no number of candidates is
    set. Groups of more than ``group`` entries are split by one more byte position.

    Null and empty texts have fingerprint 0 and are linked like any other; a text of fewer than
    ``size`` words is one shingle. Rows with one id give a row each. A null id never is a
    component's smallest; a component of null ids only has a null component_id. An empty table
    gives no rows. ``bits`` is 1 to 6.
    """
    if not 1 <= bits <= 6:
        raise ValueError("bits must be 1 to 6")
    rows = stored(fingerprints(docs, id_col, text_col, size))
    first = stored(rows.groupBy("f").agg(F.min("id").alias("least")))
    found = checkpointed(components(links(first.select("f"), bits, group)))
    roots = first.join(found.withColumnRenamed("node", "f"), "f")
    least = roots.groupBy("root").agg(F.min("least").alias("joint"))
    linked = roots.join(least, "root").select("f", "joint", "root")
    named = checkpointed(
        first.join(linked, "f", "left").select(
            "f",
            F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("joint")).alias("c"),
            F.coalesce("root", "f").alias("component"),
        )
    )
    return lookup(rows, named, ["f"], "left").select(
        col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("f"), 16, "0")).alias("fingerprint"),
        F.col("c").alias("component_id"),
        "component",
        "row_hash",
    )
