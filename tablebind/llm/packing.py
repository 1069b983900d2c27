"""Packing of tokenized documents into sequences by cutting-stock column generation."""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablebind.llm.common import id_text, map_batches, texts
from tablebind.llm.tokenizer import id_runs, ids_owner
from tablebind.plans.checkpoints import checkpointed, stored

#: Classes of lengths in each doubling, lengths told apart however large, and pieces ranked by one task.
CLASSES, COARSEST, RANKED = 64, 16, 5_000
#: A pattern enters the linear program if it is better by more than this.
GAIN = 1e-4
#: With care, a column leaves the basis only if the new pattern has more of it than this.
PIVOT = 1e-6


def size_class(length: Column, capacity: int) -> Column:
    """The length that a piece is counted as: exact up to 2 * CLASSES, then rounded up by less than
    a part in CLASSES, and by less than COARSEST (or a part in 256 of a larger capacity)."""
    size, step = length, 2
    while CLASSES * step < capacity:
        wide = min(step, max(COARSEST, capacity // 256))
        size = F.when(length > CLASSES * step, F.ceil(length / wide) * wide).otherwise(size)
        step *= 2
    return F.least(size, F.lit(capacity)).cast("int")


def best_pattern(prices: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Knapsack by dynamic programming: how often to take each size for the highest price.

    Sizes are tried by price for a token; one that others make up for as much is left out.
    """
    worth, steps = np.zeros(capacity + 1), []
    for k in np.argsort(-prices / sizes, kind="stable"):
        size, price = int(sizes[k]), float(prices[k])
        if price <= worth[size] + 1e-12:
            continue
        # Any number of copies: the running maximum along each remainder, less the copies' price.
        rows = capacity // size + 1
        table = np.full(rows * size, -np.inf)
        table[: capacity + 1] = worth
        paid = np.arange(rows)[:, None] * price
        better = np.maximum.accumulate(table.reshape(rows, size) - paid, axis=0) + paid
        steps.append((k, size, price, worth))
        worth = better.ravel()[: capacity + 1]
        worth = np.maximum(worth, steps[-1][3])
    pattern, room = np.zeros(len(sizes), np.int64), capacity
    for k, size, price, before in reversed(steps):
        copies = np.arange(room // size + 1)
        taken = int((before[room - copies * size] + copies * price).argmax())
        pattern[k] += taken
        room -= taken * size
    return float(worth[capacity]), pattern


def relaxed(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Linear program: patterns (columns) and how often each is used, fewest sequences in all.

    Revised simplex; a column that prices above 1 + GAIN enters until there is none, or until the
    sequences are as few as the tokens allow by that share. It begins with the fullest patterns
    of what is left, each used until a size runs out, which are a triangular basis. If
    rounding errors make a later basis singular, the turns are taken again with care.
    """
    m = len(sizes)
    basis, left = np.zeros((m, m)), demand.copy()
    for _ in range(m):
        pattern = fullest(sizes, np.ceil(left).astype(np.int64), capacity)
        ratio = np.where(pattern > 0, left / np.maximum(pattern, 1), np.inf)
        out = int(ratio.argmin())
        basis[:, out] = pattern
        left = np.maximum(left - ratio[out] * pattern, 0)
        left[out] = 0
        if not left.any():
            break
    for k in np.flatnonzero(~basis.any(axis=0)):  # sizes that ran out with another one
        basis[k, k] = capacity // sizes[k]
    try:
        return _simplex(basis.copy(), sizes, demand, capacity, careful=False)
    except np.linalg.LinAlgError:
        return _simplex(basis, sizes, demand, capacity, careful=True)


def _simplex(
    basis: np.ndarray, sizes: np.ndarray, demand: np.ndarray, capacity: int, careful: bool
) -> tuple[np.ndarray, np.ndarray]:
    """The turns of the linear program. If ``careful``, no pattern enters by an element of rounding
    size, and a basis that is singular all the same ends the turns at the last sound one."""
    m = len(sizes)
    inverse = np.linalg.inv(basis)
    least = float(demand @ sizes) / capacity
    sound = basis.copy(), inverse.copy()  # as last inverted afresh
    for turn in range(1, 4 * m + 1):
        if turn % 60 == 0:
            fresh = _inverted(basis) if careful else np.linalg.inv(basis)
            if fresh is None:
                break
            inverse, sound = fresh, (basis.copy(), fresh.copy())
        used = inverse @ demand
        if used.sum() <= least * (1 + GAIN):
            break
        worth, pattern = best_pattern(np.maximum(inverse.sum(axis=0), 0), sizes, capacity)
        if worth <= 1 + GAIN:
            break
        way = inverse @ pattern
        if careful:
            way += inverse @ (pattern - basis @ way)
            used = np.maximum(used, 0)
        pivot = PIVOT if careful else 1e-9
        ratio = np.where(way > pivot, used / np.where(way > pivot, way, 1), np.inf)
        out = int(ratio.argmin())
        if careful:  # of those that run out first, the one that leaves the basis furthest from singular
            out = int(np.where(ratio <= ratio.min() + 1e-9, way, -np.inf).argmax())
        if not np.isfinite(ratio[out]):
            break
        basis[:, out] = pattern
        inverse[out] /= way[out]
        others = np.arange(m) != out
        inverse[others] -= np.outer(way[others], inverse[out])
    inverse = _inverted(basis) if careful else np.linalg.inv(basis)
    if inverse is None:
        basis, inverse = sound
    return np.rint(basis).astype(np.int64), np.maximum(inverse @ demand, 0)


def _inverted(basis: np.ndarray) -> np.ndarray | None:
    """The inverse of a basis, or None if rounding errors of earlier turns made it singular."""
    try:
        inverse = np.linalg.inv(basis)
    except np.linalg.LinAlgError:
        return None
    return inverse if np.abs(basis @ inverse - np.eye(len(basis))).max() < 1e-3 else None


def fullest(sizes: np.ndarray, left: np.ndarray, capacity: int) -> np.ndarray:
    """The fullest sequence out of what is left, with large pieces where there is a choice."""
    parts = []  # (size index, copies, tokens): powers of two, so that every count can be made up
    for k in range(len(sizes) - 1, -1, -1):
        size = int(sizes[k])
        copies, rest = 1, min(int(left[k]), capacity // size)
        while rest > 0:
            parts.append((k, min(copies, rest), size * min(copies, rest)))
            rest -= copies
            copies *= 2
    # The rooms that can be filled by the first parts, as bits.
    reach, every = [1], (1 << capacity + 1) - 1
    for _, _, tokens in parts:
        reach.append((reach[-1] | reach[-1] << tokens) & every)
        if reach[-1] >> capacity:
            break
    room, j = reach[-1].bit_length() - 1, len(reach) - 1
    # The first row that reaches the room used only the largest pieces.
    pattern = np.zeros(len(sizes), np.int64)
    while room > 0:
        while j and reach[j - 1] >> room & 1:
            j -= 1
        k, copies, tokens = parts[j - 1]
        pattern[k] += copies
        room -= tokens
        j -= 1
    return pattern


def _used_up(
    sizes: np.ndarray, demand: np.ndarray, capacity: int, columns: list[tuple[float, np.ndarray]]
) -> list[tuple[int, np.ndarray]]:
    """``columns`` (how often, pattern) rounded down; what is left becomes the fullest sequences."""
    left, chosen = demand.copy(), []
    for often, pattern in columns:
        fits = np.min(left[pattern > 0] // pattern[pattern > 0], initial=np.iinfo(np.int64).max)
        times = int(min(np.floor(often + 1e-6), fits))
        if times:
            chosen.append((times, pattern))
            left = left - times * pattern
    while left.any():
        pattern = fullest(sizes, left, capacity)
        times = int(np.min(left[pattern > 0] // pattern[pattern > 0]))
        chosen.append((times, pattern))
        left = left - times * pattern
    return chosen


def cutting_stock(demand: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(times, {size: pieces}) that use up ``demand`` exactly, each within ``capacity``.

    The linear program's patterns are rounded down and what is left is made into the fullest
    sequences one by one; or all is, if that takes fewer. The work depends on the number of
    sizes, not on the demand.
    """
    sizes = np.array(sorted(s for s, n in demand.items() if n > 0), np.int64)
    if not len(sizes):
        return []
    wanted = np.array([demand[s] for s in sizes.tolist()], np.int64)
    patterns, used = relaxed(sizes, wanted.astype(float), capacity)
    columns = [(used[k], patterns[:, k]) for k in np.argsort(-used, kind="stable")]
    plans = [_used_up(sizes, wanted, capacity, c) for c in (columns, [])]
    return [
        (times, {int(s): int(n) for s, n in zip(sizes, pattern, strict=True) if n})
        for times, pattern in min(plans, key=lambda p: sum(times for times, _ in p))
    ]


def pieces(
    docs: DataFrame, path: str, id_col: str, text_col: str, capacity: int, end: int, with_ids: bool
) -> DataFrame:
    """Documents as tokens, cut every ``capacity`` tokens."""
    stop = np.array([end], "<u4").tobytes()

    def cut(batches):
        runs = id_runs(path)
        for batch in batches:
            rows = []
            for key, text in zip(batch.column("id").to_pylist(), texts(batch, "text"), strict=True):
                ids = b"".join(map(runs.__getitem__, text.split())) + stop
                for start in range(0, len(ids), 4 * capacity):
                    piece = ids[start : start + 4 * capacity]
                    rows.append(
                        (key, start // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4, piece)
                    )
            for at in range(0, len(rows), 4096):
                part = rows[at : at + 4096]
                columns = [pa.array([r[k] for r in part], pa.int64()) for k in range(5)]
                if with_ids:
                    columns.append(pa.array([r[5] for r in part], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    return map_batches(
        id_text(docs, id_col, text_col), cut, schema + ", ids binary" * with_ids, ids_owner(path)
    )


def pack(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 4096,
    end: int = 2,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and
    ``ids`` (little-endian unsigned 32-bit) if asked for.

    A document is its ids and ``end``. It is cut every ``capacity`` tokens; no other cut is made.
    Lengths are counted in classes, exact for short ones and a percent or less wide for others, so
    the histogram, which alone goes to the driver, has some hundred bars for any input. Column
    generation turns it into patterns.
    Pieces of a bar are ranked (within salted parts, so that a frequent length is no hot group)
    and the rank says which sequence of which pattern a piece goes to.

    A null or empty text is the end token alone. Repeated rows are packed each; a null id stays
    null; an empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    cut = stored(pieces(docs, path, id_col, text_col, capacity, end, with_ids))
    parts = 1 + cut.count() // RANKED
    sized = cut.withColumns(
        {
            "_size": size_class(F.col("length"), capacity),
            "_part": F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(parts)),
        }
    )
    counts = checkpointed(sized.groupBy("_size", "_part").count())
    demand = {r[0]: r[1] for r in counts.groupBy("_size").agg(F.sum("count")).collect()}
    slots, base = [], 0
    ranked = dict.fromkeys(demand, 0)
    for times, pattern in cutting_stock(demand, capacity):
        for size, n in pattern.items():
            slots.append((size, ranked[size], ranked[size] + n * times, n, base))
            ranked[size] += n * times
        base += times
    table = spark.createDataFrame(
        slots, "_size int, _from long, _to long, _each long, _base long"
    )
    before = W.partitionBy("_size").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    earlier = counts.select(
        "_size", "_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before")
    )
    within = W.partitionBy("_size", "_part").orderBy("ids_crc32", "doc_id", "start", "doc_tokens")
    placed = (
        sized.withColumn("_row", F.row_number().over(within) - 1)
        .join(earlier.hint("shuffle_merge"), ["_size", "_part"])
        .withColumn("_rank", F.col("_row") + F.col("_before"))
        .alias("p")
        .join(
            F.broadcast(table).alias("s"),  # at most some slots for each of the bars
            F.expr("p._size = s._size and p._rank >= s._from and p._rank < s._to"),
        )
        .withColumns(
            {
                "sequence_id": F.expr("_base + (_rank - _from) div _each"),
                "_slot": F.expr("(_rank - _from) % _each"),
            }
        )
    )
    order = W.partitionBy("sequence_id").orderBy(F.col("p._size").desc(), "_slot")
    ahead = F.sum("length").over(order.rowsBetween(W.unboundedPreceding, -1))
    return placed.select(
        "doc_id",
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        "sequence_id",
        F.coalesce(ahead, F.lit(0)).cast("long").alias("offset"),
        *(["ids"] if with_ids else []),
    )
