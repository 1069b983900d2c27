"""Hard negatives by an R-tree over vectors, packed by sort-tile-recursive.

Rows are tiled in Spark: cut into slabs by the coordinate that varies most, and each slab into
tiles by the next one, both by exact ranks, so equal vectors are dealt out like any others. Every
tile is packed further in the task that searches it. A box holds an interval for each coordinate,
for the labels and for the ids; the intervals bound the inner product with an anchor. A best-first
queue opens the box with the highest bound, as long as one of the anchor's searches can gain by it.
"""

import heapq
import math
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablebind.functions.names import col
from tablebind.plans.checkpoints import stored
from tablebind.plans.ordered import POSITION, place_by_runs

#: Rows of a leaf and boxes of a box above.
LEAF, FANOUT = 128, 8
#: Rows of a tile: 64 tiles of a table, within these bounds.
TILES, TILE_ROWS, MOST_TILE_ROWS = 64, 1024, 65_536
#: Anchors that meet one copy of a tile, and those whose bounds are worked out at once.
ANCHORS, AT_ONCE = 65_536, 1024
#: The score of a search without limits.
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1
#: Whole numbers below this are exact as floating point.
EXACT = 2.0**53

FOUND = "anchor_id long, search int, id long, score long"


def scaled(rows: DataFrame, id_col: str, vector_col: str, label_col: str, factor: int) -> DataFrame:
    """Usable rows as id, label and v (whole numbers); of rows with one id the least."""
    v = F.transform(col(vector_col), lambda x: F.floor(F.lit(factor) * x.cast("double")))
    usable = F.forall(
        col(vector_col), lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < math.inf)
    )
    most = F.floor(F.sqrt(F.lit(2.0**62) / F.greatest(F.size("v"), F.lit(1))))
    return (
        rows.where(col(id_col).isNotNull() & col(label_col).isNotNull() & col(vector_col).isNotNull() & usable)
        .select(col(id_col).cast("long").alias("id"), col(label_col).cast("long").alias("label"), v.alias("v"))
        .where(F.forall("v", lambda x: F.abs(x) <= most))
        .groupBy("id")
        .agg(F.min(F.struct("label", "v")).alias("row"))
        .select("id", "row.label", "row.v")
    )


def _coordinates(rows: DataFrame, length: int) -> list[int]:
    """Places of the vector by falling variance."""
    at = [F.coalesce(F.try_element_at("v", F.lit(k + 1)), F.lit(0)).cast("double") for k in range(length)]
    spread = rows.agg(*[F.var_pop(x) for x in at]).first()
    return sorted(range(length), key=lambda k: (-(spread[k] or 0), k))


def tiles(rows: DataFrame, count: int, length: int, tile_rows: int) -> tuple[DataFrame, int, list[int]]:
    """``rows`` with a ``tile`` number, the number of tiles, and the order of coordinates."""
    by = _coordinates(rows, length)
    pages = max(1, -(-count // tile_rows))
    slabs = math.isqrt(pages - 1) + 1
    runs = -(-pages // slabs)

    def value(k: int) -> Column:
        return F.coalesce(F.try_element_at("v", F.lit(by[k] + 1)), F.lit(0)) if k < length else F.lit(0)

    def cut(df: DataFrame, keys: list[str], k: int, parts: int, size: Column, name: str) -> DataFrame:
        placed = place_by_runs(df.withColumn("x", value(k).cast("long")), keys, ["x"], {}, count, tile_rows, ties=["id"])
        # Ranks dealt out evenly: parts differ by one row at most.
        return placed.select(
            "id", "label", "v", *keys, F.floor(F.col(POSITION) * parts / size).cast("int").alias(name)
        )

    slabbed = cut(rows, [], 0, slabs, F.lit(count), "slab")
    # The rows of a slab are known from its number.
    first = F.ceil(F.col("slab") * F.lit(count) / F.lit(slabs))
    size = F.ceil((F.col("slab") + 1) * F.lit(count) / F.lit(slabs)) - first
    tiled = cut(slabbed, ["slab"], 1, runs, size, "run")
    tiled = tiled.select("id", "label", "v", (F.col("slab") * runs + F.col("run")).cast("long").alias("tile"))
    return tiled, slabs * runs, by


@dataclass
class Tree:
    """A packed tile. Boxes are numbered level by level from the leaves; ``rows`` and ``below`` give
    a leaf's rows and a box's boxes as ranges."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    low: np.ndarray
    high: np.ndarray
    label_low: np.ndarray
    label_high: np.ndarray
    least_id: np.ndarray
    ranges: np.ndarray
    leaves: int
    root: int

    def __post_init__(self):
        #: What a search looks at box by box.
        arrays = (self.label_low, self.label_high, self.least_id, self.ranges)
        self.lists = tuple(x.tolist() for x in arrays)
        self.most = float(np.abs(self.vectors).max(initial=0))

    def as_floats(self) -> "Tree":
        return replace(self, vectors=self.vectors.astype(np.float64))


def _tiled(order: np.ndarray, keys: list[np.ndarray], ids: np.ndarray, leaf: int) -> list[np.ndarray]:
    """``order`` cut into leaves: sorted by a key and sliced, each slice by the next key."""
    pages = -(-len(order) // leaf)
    if not keys or pages <= 1:
        order = order[np.argsort(ids[order], kind="stable")] if not keys else order
        return [order[k : k + leaf] for k in range(0, len(order), leaf)]
    order = order[np.lexsort((ids[order], keys[0][order]))]
    slices = max(1, round(pages ** (1 / len(keys))))
    rows = -(-pages // slices) * leaf
    return [x for k in range(0, len(order), rows) for x in _tiled(order[k : k + rows], keys[1:], ids, leaf)]


def packed(ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, by: list[int]) -> Tree:
    """The R-tree of a tile: labels are the first key, then the coordinates that tiles are not cut by."""
    keys = [labels, *[vectors[:, k] for k in by[2:4]]]
    leaves = _tiled(np.arange(len(ids)), keys, ids, LEAF)
    order = np.concatenate(leaves)
    ids, labels, vectors = ids[order], labels[order], vectors[order]
    ends = np.cumsum([len(x) for x in leaves])
    ranges = [np.stack([np.concatenate([[0], ends[:-1]]), ends], axis=1)]
    starts = ranges[0][:, 0]
    boxes = [
        (
            np.minimum.reduceat(vectors, starts, axis=0),
            np.maximum.reduceat(vectors, starts, axis=0),
            np.minimum.reduceat(labels, starts),
            np.maximum.reduceat(labels, starts),
            np.minimum.reduceat(ids, starts),
        )
    ]
    base = 0
    while len(boxes[-1][0]) > 1:
        low, high, label_low, label_high, least = boxes[-1]
        starts = np.arange(0, len(low), FANOUT)
        ends = np.minimum(starts + FANOUT, len(low))
        ranges.append(np.stack([starts + base, ends + base], axis=1))
        base += len(low)
        boxes.append(
            (
                np.minimum.reduceat(low, starts, axis=0),
                np.maximum.reduceat(high, starts, axis=0),
                np.minimum.reduceat(label_low, starts),
                np.maximum.reduceat(label_high, starts),
                np.minimum.reduceat(least, starts),
            )
        )
    parts = [np.concatenate(x) for x in zip(*boxes, strict=True)]
    return Tree(ids, labels, vectors, *parts, np.concatenate(ranges), len(leaves), len(parts[0]) - 1)


def products(vectors: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers, by floating point where that is exact."""
    most = float(np.abs(vectors).max(initial=0)) * float(np.abs(queries).max(initial=0)) * vectors.shape[1]
    if most < EXACT:
        return (vectors.astype(np.float64) @ queries.astype(np.float64).T).astype(np.int64)
    return vectors @ queries.T


class Search:
    """The best rows of one score window: highest scores first, ties by smaller id."""

    __slots__ = ("low", "high", "k", "best")

    def __init__(self, low: int, high: int, k: int):
        self.low, self.high, self.k, self.best = low, high, k, []

    def floor(self) -> int:
        """No lower score belongs to the result."""
        return self.low if len(self.best) < self.k else max(self.low, self.best[0][0])

    def gains(self, low: int, high: int, least_id: int) -> bool:
        """Whether a box with these bounds can hold a row that belongs to the result."""
        if high < self.low or low > self.high:
            return False
        if len(self.best) < self.k:
            return True
        score, negated = self.best[0]
        return (min(high, self.high), -least_id) > (score, negated)

    def offer(self, score: int, row_id: int) -> None:
        if self.low <= score <= self.high:
            item = (score, -row_id)
            if len(self.best) < self.k:
                heapq.heappush(self.best, item)
            elif item > self.best[0]:
                heapq.heapreplace(self.best, item)


def search(tree: Tree, anchor: int, label: int, vector: np.ndarray, same: bool, searches: list[Search], bounds) -> None:
    """All searches of an anchor in one pass over a tile: rows of its label (other than itself) or
    of the other labels. ``bounds`` has the lowest and highest score of each box. Tile and anchor
    are both whole numbers or both floating point that is exact."""
    lows, highs = bounds
    first, last, least, ranges = tree.lists
    least_low, most_high = min(s.low for s in searches), max(s.high for s in searches)

    def useful(box: int) -> bool:
        if same:
            if not first[box] <= label <= last[box]:
                return False
        elif first[box] == label == last[box]:
            return False
        low, high = lows[box], highs[box]
        if high < least_low or low > most_high:
            return False
        for s in searches:
            if s.gains(low, high, least[box]):
                return True
        return False

    queue = [(-highs[tree.root], least[tree.root], tree.root)]
    while queue:
        box = heapq.heappop(queue)[2]
        if not useful(box):
            continue
        a, b = ranges[box]
        if box >= tree.leaves:
            for x in range(a, b):
                if useful(x):
                    heapq.heappush(queue, (-highs[x], least[x], x))
            continue
        scores = tree.vectors[a:b] @ vector
        kept = (scores >= min(s.floor() for s in searches)) & (scores <= most_high)
        found = np.flatnonzero(kept)
        found = found[(tree.labels[a:b][found] == label) == same]
        for score, row_id in zip(scores[found].tolist(), tree.ids[a:b][found].tolist(), strict=True):
            if row_id != anchor:
                for s in searches:
                    s.offer(int(score), row_id)


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    """Vectors as rows of one length; shorter ones end in zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), length), np.int64)
    out[np.arange(length) < sizes[:, None]] = column.flatten().to_numpy()
    return out


def _search_tiles(batches, length: int, by: list[int], same: bool, k: int):
    """Rows come by tile and block, the tile's own rows (kind 0) first, then anchors (kind 1)."""
    here, gathered, tree, floats = None, [], None, None

    def found(queries):
        nonlocal tree, gathered, floats
        if tree is None:
            if not gathered:
                return
            tree, gathered = packed(*(np.concatenate(x) for x in zip(*gathered, strict=True)), by), []
            floats = tree.as_floats()
        ids, labels, vectors, lows, highs = queries
        up, down = np.maximum(vectors, 0), np.minimum(vectors, 0)
        high = products(tree.high, up) + products(tree.low, down)
        low = products(tree.low, up) + products(tree.high, down)
        out = []
        exact = tree.most * float(np.abs(vectors).max(initial=0)) * length < EXACT
        index, vectors = (floats, vectors.astype(np.float64)) if exact else (tree, vectors)
        for q, anchor in enumerate(ids.tolist()):
            searches = [Search(a, b, k) for a, b in zip(lows[q], highs[q], strict=True)]
            bounds = low[:, q].tolist(), high[:, q].tolist()
            search(index, anchor, int(labels[q]), vectors[q], same, searches, bounds)
            out += [(anchor, n, -i, s) for n, x in enumerate(searches) for s, i in x.best]
        columns = list(zip(*out, strict=True)) or [[]] * 4
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["anchor_id", "search", "id", "score"]
        )

    for batch in batches:
        places = np.stack([batch.column(c).to_numpy() for c in ("tile", "block", "kind")], axis=1)
        edges = np.flatnonzero((np.diff(places, axis=0) != 0).any(axis=1)) + 1
        bounds = [0, *edges.tolist(), len(places)]
        for a, b in zip(bounds, bounds[1:]):
            if a == b:
                continue
            part = batch.slice(a, b - a)
            place = tuple(places[a, :2])
            if place != here:
                here, gathered, tree = place, [], None
            ids, labels = (part.column(c).to_numpy() for c in ("id", "label"))
            vectors = _matrix(part.column("v"), length)
            if places[a, 2] == 0:
                gathered.append((ids, labels, vectors))
            else:
                limits = [part.column(c).to_pylist() for c in ("lows", "highs")]
                for n in range(0, len(ids), AT_ONCE):
                    yield from found([x[n : n + AT_ONCE] for x in (ids, labels, vectors, *limits)])


def best_rows(tiled: DataFrame, n_tiles: int, anchors: DataFrame, n_anchors: int, length: int, by: list[int], same: bool, k: int) -> DataFrame:
    """For each anchor (id, label, v, lows, highs) and search the ``k`` best rows of all tiles.

    Anchors in blocks meet tiles: tiles are repeated for every block of ANCHORS anchors, anchors
    for every tile. Tasks return ``k`` rows a search at most; the rest is a top-k of those.
    """
    blocks = max(1, -(-n_anchors // ANCHORS))
    nothing = F.lit(None).cast("array<long>")

    def each(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    sides = tiled.select(
        "tile", each(blocks).alias("block"),
        F.lit(0).cast("long").alias("kind"), "id", "label", "v", nothing.alias("lows"), nothing.alias("highs"),
    ).union(
        anchors.select(
            each(n_tiles).alias("tile"),
            F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block"),
            F.lit(1).cast("long").alias("kind"), "id", "label", "v", "lows", "highs",
        )
    )
    ordered = sides.repartition("tile", "block").sortWithinPartitions("tile", "block", "kind")
    found = ordered.mapInArrow(lambda batches: _search_tiles(batches, length, by, same, k), FOUND)
    order = Window.partitionBy("anchor_id", "search").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    rows: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    anchors_every: int = 100,
    positives: int = 5,
    negatives: int = 5,
    low_percent: int = 80,
    high_percent: int = 100,
    factor: int = 256,
    tile_rows: int | None = None,
) -> DataFrame:
    """For each anchor and positive the hardest negatives: anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score.

    Anchors are the rows whose id is divisible by ``anchors_every``; a score is the inner product
    of vectors whose components were multiplied by ``factor`` and rounded down. An anchor's
    positives are the best other rows of its label; a positive's negatives the best rows of other
    labels with a score from ``low_percent`` to ``high_percent`` of the positive's. Ties go to the
    smaller id.

    Rows with a null id or label, a null vector or a null or non-finite component take no part, nor
    do vectors whose inner product could pass a long (components above the root of 2**62 by the
    length). Of rows with one id the one with the least label, then vector, counts. Vectors of
    unequal length are compared as if the shorter ended in zeros; empty ones score 0. An anchor
    without positives or without negatives in the window gives no rows; so does an empty table.
    Other columns are not read. Search is exact; nothing is capped but the numbers asked for.
    """
    usable = stored(scaled(rows, id_col, vector_col, label_col, factor))
    anchor = F.col("id") % anchors_every == 0
    count, n_anchors, length = usable.agg(F.count("*"), F.count_if(anchor), F.max(F.size("v"))).first()
    length = max(length or 0, 1)
    size = tile_rows or min(max(-(-count // TILES), TILE_ROWS), MOST_TILE_ROWS)
    tiled, n_tiles, by = tiles(usable, count, length, size)
    tiled = stored(tiled)
    every = F.array(F.lit(LOWEST).cast("long")), F.array(F.lit(HIGHEST).cast("long"))
    first = usable.where(anchor).select("id", "label", "v", every[0].alias("lows"), every[1].alias("highs"))
    best = best_rows(tiled, n_tiles, first, n_anchors, length, by, True, positives)
    best = stored(best.select("anchor_id", F.col("rank").alias("n"), F.col("id").alias("p"), F.col("score").alias("s")))
    # At most ``positives`` rows an anchor. The least score with 100 * score >= low * positive.
    limits = best.groupBy(F.col("anchor_id").alias("id")).agg(
        F.array_sort(F.collect_list(F.struct("n", "s"))).alias("found")
    )

    def share(score: Column, percent: int) -> Column:
        return score.cast("decimal(20,0)") * F.lit(percent) / F.lit(100)

    low = F.transform("found", lambda x: F.ceil(share(x["s"], low_percent)).cast("long"))
    high = F.transform("found", lambda x: F.floor(share(x["s"], high_percent)).cast("long"))
    second = usable.where(anchor).join(
        limits.select("id", low.alias("lows"), high.alias("highs")), "id"
    )
    worst = best_rows(tiled, n_tiles, second.select("id", "label", "v", "lows", "highs"), n_anchors, length, by, False, negatives)
    named = worst.withColumn("n", F.col("search") + 1).join(best, ["anchor_id", "n"])
    return named.select(
        "anchor_id",
        F.col("p").alias("positive_id"),
        F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"),
        F.col("s").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
