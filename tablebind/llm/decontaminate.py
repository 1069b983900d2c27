"""Benchmark passages in training texts, found through an FM-index of each shard."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablebind.functions.names import balanced, col
from tablebind.llm.common import BATCH_ROWS, WORD, alphanumeric_words, map_batches, texts
from tablebind.plans.checkpoints import stored
from tablebind.plans.joins import lookup

#: Every so many text positions, the index keeps a suffix position.
SAMPLE = 16
#: Bytes of benchmark text searched in one pass over the documents: some 25 bytes of windows each.
BLOCK_BYTES = 8 * 1024 * 1024


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix positions in order, by doubling; sorts only while suffixes are tied."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    rank = np.empty(n, np.int64)
    width = 1
    changed = np.concatenate([[0], np.cumsum(np.diff(text[order]) != 0)])
    rank[order] = changed
    while changed[-1] < n - 1:
        later = np.zeros(n, np.int64)
        later[: max(0, n - width)] = rank[width:] + 1
        key = rank * (n + 1) + later
        order = np.argsort(key, kind="stable")
        changed = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        rank[order] = changed
        width *= 2
    return order


class FMIndex:
    """Counts and places of patterns in a text of numbers; 0 separates runs and is never searched."""

    def __init__(self, text: np.ndarray):
        # A number below all others ends the text, so that all suffixes differ.
        text = np.concatenate([text.astype(np.int64) + 1, [0]])
        suffixes = suffix_array(text)
        last = text[suffixes - 1]
        self.n = len(text)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=2))])
        self.zeros: list[np.ndarray] = []  # wavelet levels: zeros before each place
        self.split: list[int] = []
        self.levels = range(max(1, int(text.max()).bit_length()) - 1, -1, -1)
        for level in self.levels:
            bit = (last >> level) & 1
            self.zeros.append(np.concatenate([[0], np.cumsum(bit == 0)]).astype(np.int32))
            self.split.append(int(self.zeros[-1][-1]))
            last = np.concatenate([last[bit == 0], last[bit == 1]])
        kept = suffixes % SAMPLE == 0
        self.sampled = np.concatenate([[0], np.cumsum(kept)])
        self.positions = suffixes[kept]

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands before ``place`` in the transformed text."""
        start = np.zeros_like(place)
        for level, zeros, split in zip(self.levels, self.zeros, self.split, strict=True):
            one = (symbol >> level) & 1 == 1
            a, b = zeros[place], zeros[start]
            place = np.where(one, split + place - a, a)
            start = np.where(one, split + start - b, b)
        return place - start

    def step(self, place: np.ndarray) -> np.ndarray:
        """The place of the suffix that is one symbol longer."""
        symbol, at = np.zeros_like(place), place
        for zeros, split in zip(self.zeros, self.split, strict=True):
            before = zeros[at].astype(np.int64)
            one = zeros[at + 1] == before
            symbol = symbol * 2 + one
            at = np.where(one, split + at - before, before)
        return self.first[symbol] + self.rank(symbol, place)

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of suffixes that begin with each pattern; rows are filled on the right with 0."""
        low = np.zeros(len(patterns), np.int64)
        high = np.full(len(patterns), self.n, np.int64)
        for step in range(patterns.shape[1]):
            live = np.flatnonzero((step < lengths) & (low < high))
            if not len(live):
                break
            symbol = patterns[live, lengths[live] - 1 - step].astype(np.int64) + 1
            known = symbol < len(self.first) - 1
            high[live[~known]] = low[live[~known]]
            live, symbol = live[known], symbol[known]
            start = self.first[symbol]
            low[live], high[live] = (
                start + self.rank(symbol, low[live]),
                start + self.rank(symbol, high[live]),
            )
        return low, high

    def locate(self, places: np.ndarray) -> np.ndarray:
        """Text positions of suffixes: walk left until a sampled one is met."""
        found = np.full(len(places), -1, np.int64)
        open_, places = np.arange(len(places)), places.copy()
        for walked in range(SAMPLE):
            if not len(open_):
                break
            known = self.sampled[places + 1] > self.sampled[places]
            found[open_[known]] = self.positions[self.sampled[places[known]]] + walked
            open_, places = open_[~known], self.step(places[~known])
        return found


class Windows:
    """The distinct windows of benchmark items, as rows of word numbers that end in zeros, and whose
    they are (the numbers of items from one place of ``at`` to the next)."""

    def __init__(self, items: list[tuple[str, bytes]], size: int):
        self.words: dict[bytes, int] = {}
        self.items = sorted({item for item, _ in items})
        number = {item: k for k, item in enumerate(self.items)}
        texts = []
        for item, text in items:
            words = alphanumeric_words(text)
            ids = [self.words.setdefault(w, len(self.words) + 1) for w in words]
            if ids:
                texts.append((number[item], np.array(ids + [0] * (size - len(ids)), np.int32)))
        counts = [len(ids) - size + 1 for _, ids in texts]
        rows = np.zeros((sum(counts), size), np.int32)
        ends = np.cumsum(counts, dtype=np.int64)
        for (_, ids), n, end in zip(texts, counts, ends, strict=True):
            rows[end - n : end] = np.lib.stride_tricks.sliding_window_view(ids, size)
        owner = np.repeat(np.array([k for k, _ in texts], np.int64), counts)
        distinct, which = np.unique(rows.view(f"V{4 * size}").ravel(), return_inverse=True)
        self.patterns = distinct.view(np.int32).reshape(-1, size)
        self.lengths = (self.patterns > 0).sum(axis=1)
        self.shortest = int(self.lengths.min(initial=size))
        pairs = np.unique(which * (len(self.items) + 1) + owner)
        self.owners = (pairs % (len(self.items) + 1)).astype(np.int32)
        self.at = np.searchsorted(pairs // (len(self.items) + 1), np.arange(len(self.patterns) + 1))

    def items_of(self, windows: np.ndarray) -> set[str]:
        held = [self.owners[self.at[w] : self.at[w + 1]] for w in windows.tolist()]
        return {self.items[k] for k in np.unique(np.concatenate(held)).tolist()}


def shard_hits(docs: list[list[bytes]], windows: Windows):
    """Hit flags of all words of a shard, word offsets of its documents, and document -> items.

    Words outside the benchmark become separators; a run between separators that is shorter than
    every window can't hold one, so the index is built over the other runs.
    """
    offsets = np.concatenate([[0], np.cumsum([len(d) + 1 for d in docs])]).astype(np.int64)
    hit = np.zeros(int(offsets[-1]) + 1, np.int64)
    if not len(windows.patterns):
        return hit[:-1] > 0, offsets, {}
    number = windows.words.get
    ids = np.fromiter(
        (x for d in docs for x in (*[number(w, 0) for w in d], 0)), np.int64, int(offsets[-1])
    )
    edges = np.flatnonzero(np.diff(np.concatenate([[0], ids > 0, [0]]).astype(np.int8)))
    begin, end = edges[::2], edges[1::2]
    long = end - begin >= windows.shortest
    begin, end = begin[long], end[long]
    if not len(begin):
        return hit[:-1] > 0, offsets, {}
    size = end - begin + 1  # with the separator after the run, which ids has as 0 or another word
    starts = np.concatenate([[0], np.cumsum(size)])
    place = np.arange(starts[-1]) - np.repeat(starts[:-1] - begin, size)
    text = ids[place]
    text[starts[1:] - 1] = 0
    index = FMIndex(text)
    low, high = index.search(windows.patterns, windows.lengths)
    which = np.flatnonzero(high > low)
    if not len(which):
        return hit[:-1] > 0, offsets, {}
    times = (high - low)[which]
    window = np.repeat(which, times)
    first = np.concatenate([[0], np.cumsum(times)])[:-1]
    rows = np.arange(times.sum()) + np.repeat(low[which] - first, times)
    at = place[index.locate(rows)]
    np.add.at(hit, at, 1)
    np.add.at(hit, at + windows.lengths[window], -1)
    doc = np.searchsorted(offsets, at, "right") - 1
    pairs = np.unique(doc * len(windows.patterns) + window)
    docs_hit, first = np.unique(pairs // len(windows.patterns), return_index=True)
    each = np.split(pairs % len(windows.patterns), first[1:])
    found = {d: windows.items_of(w) for d, w in zip(docs_hit.tolist(), each, strict=True)}
    return np.cumsum(hit[:-1]) > 0, offsets, found


def _runs(flags: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.diff(np.concatenate([[0], flags, [0]]).astype(np.int8))).reshape(-1, 2)


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int):
    """The benchmark in parts of about ``block_bytes``, each taken to the driver by itself."""
    side = benchmark.select(
        F.coalesce(col(id_col).cast("string"), F.lit("")).alias("item"),
        F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    total = side.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    parts = 1 + total // block_bytes
    for k in range(parts):
        mine = F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == k
        yield [(r[0], r[1].encode()) for r in side.where(mine).collect()]


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    block_bytes: int = BLOCK_BYTES,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, items (sorted texts), hits and spans.

    ``hits`` are runs of hit words, ``spans`` the same runs as code points of the text, both as
    flat arrays of starts and ends (end exclusive). ``keep`` names columns to pass through.

    Each batch of documents is a shard with an FM-index of its own, searched for every window.
    The benchmark comes in blocks of bounded size. One block is searched in one pass over the
    texts, without a shuffle. Of more blocks, each is searched in a pass of its own that writes the
    hits, so one block at a time is in memory; the hits are merged and joined to the texts.
    Null texts have no words; null items are the empty text; repeated rows each give a row; an
    empty benchmark gives no hits.
    """
    spark = docs.sparkSession
    out = docs.select(
        col(id_col).cast("long").alias("id"),
        col(text_col).cast("string").alias("text"),
        *([F.struct(*[col(c) for c in keep]).alias("kept")] if keep else []),
    )
    kept = [f.simpleString().replace(":", " ", 1) for f in out.schema.fields[2:]]
    result = ", ".join(["id long", "text string", *kept, RESULT])
    blocks = _blocks(benchmark, item_col, item_text_col, block_bytes)
    items, more = next(blocks), next(blocks, None)
    if more is None:
        shared = spark.sparkContext.broadcast(Windows(items, window))
        return map_batches(out, lambda batches: _searched(batches, shared.value), result).withColumnRenamed(
            "id", "doc_id"
        )
    out = out.withColumn("row_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    found = []
    while items is not None:
        shared = spark.sparkContext.broadcast(Windows(items, window))
        hits = map_batches(
            out.select("id", "text", "row_hash"), lambda batches, w=shared: _hits_only(batches, w.value), HITS
        )
        # Equal rows have equal hits.
        found.append(stored(hits.dropDuplicates(["id", "row_hash"])))
        shared.destroy()
        items, more = more, next(blocks, None)
    # At most one row for each block.
    merged = balanced(found, DataFrame.union).groupBy("id", "row_hash").agg(
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
        F.flatten(F.collect_list("hits")).alias("hits"),
    )
    joined = lookup(out, stored(merged), ["id", "row_hash"], "left").drop("row_hash")
    return map_batches(joined, _finished, result).withColumnRenamed("id", "doc_id")


#: Columns that are found, for all rows and for those with hits.
RESULT = "n_words long, items array<string>, hits array<long>, spans array<long>"
HITS = "id long, row_hash long, items array<string>, hits array<long>"


def _shards(batches):
    for whole in batches:
        for start in range(0, whole.num_rows, BATCH_ROWS):
            yield whole.slice(start, BATCH_ROWS)


def _found(docs: list[list[bytes]], windows: Windows) -> dict[int, tuple[set[str], np.ndarray]]:
    """Items and runs of hit words of the documents that have any."""
    hit, offsets, found = shard_hits(docs, windows)
    return {d: (items, _runs(hit[offsets[d] : offsets[d + 1] - 1])) for d, items in found.items()}


def _searched(batches, windows: Windows):
    for batch in _shards(batches):
        data = texts(batch, "text")
        docs = [alphanumeric_words(x) for x in data]
        yield _described(batch, data, docs, _found(docs, windows))


def _hits_only(batches, windows: Windows):
    for batch in _shards(batches):
        found = _found([alphanumeric_words(x) for x in texts(batch, "text")], windows)
        mine = batch.take(pa.array(list(found), pa.int64()))
        columns = [
            mine.column("id"),
            mine.column("row_hash"),
            pa.array([sorted(items) for items, _ in found.values()], pa.list_(pa.string())),
            pa.array([runs.ravel().tolist() for _, runs in found.values()], pa.list_(pa.int64())),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["id", "row_hash", "items", "hits"])


def _finished(batches):
    """Rows with the hits of all blocks, which may overlap."""
    for batch in _shards(batches):
        data = texts(batch, "text")
        docs, found = [alphanumeric_words(x) for x in data], {}
        for d, (items, hits) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("items", "hits")), strict=True)):
            if items:
                flags = np.zeros(len(docs[d]), bool)
                for a, b in zip(hits[::2], hits[1::2], strict=True):
                    flags[a:b] = True
                found[d] = set(items), _runs(flags)
        yield _described(batch.drop_columns(["items", "hits"]), data, docs, found)


def _described(batch: pa.RecordBatch, data: list[bytes], docs: list[list[bytes]], found) -> pa.RecordBatch:
    """The columns of a batch, and those of RESULT."""
    n = batch.num_rows
    items, hits, spans = [[]] * n, [[]] * n, [[]] * n
    for d, (mine, runs) in found.items():
        places = [m.span() for m in WORD.finditer(data[d].decode())]
        items[d] = sorted(mine)
        hits[d] = runs.ravel().tolist()
        spans[d] = [x for a, b in runs for x in (places[a][0], places[b - 1][1])]
    arrays = {
        "n_words": pa.array(map(len, docs), pa.int64()),
        "items": pa.array(items, pa.list_(pa.string())),
        "hits": pa.array(hits, pa.list_(pa.int64())),
        "spans": pa.array(spans, pa.list_(pa.int64())),
    }
    return pa.RecordBatch.from_arrays(
        [*batch.columns, *arrays.values()], [*batch.schema.names, *arrays]
    )


def pairs_sum(runs: Column) -> Column:
    """Total length of a flat array of starts and ends."""
    signed = F.transform(runs, lambda x, k: F.when(k % 2 == 0, -x).otherwise(x))
    return F.aggregate(signed, F.lit(0).cast("long"), lambda a, x: a + x)


def without_spans(text: Column, spans: Column) -> Column:
    """``text`` less its spans (a flat array of starts and ends), each become one line end."""
    n = F.size(spans)
    starts = F.concat(F.array(F.lit(0).cast("long")), F.filter(spans, lambda x, k: k % 2 == 1))
    ends = F.concat(
        F.filter(spans, lambda x, k: k % 2 == 0), F.array(F.length(text).cast("long"))
    )
    kept = F.zip_with(
        starts, ends, lambda a, b: F.substring(text, (a + 1).cast("int"), (b - a).cast("int"))
    )
    return F.when(n > 0, F.array_join(kept, "\n")).otherwise(text)
