"""Language model of a corpus by pairs or triples of words, and the score of every text under it."""

import tempfile
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablebind.llm.common import id_text, lower_words, map_batches, remainder, texts
from tablebind.llm.elias_fano import Trie
from tablebind.plans.checkpoints import stored

#: Tokens of a block of texts; entries of a shard of words, and of a shard of word pairs.
BLOCK_TOKENS, WORD_ENTRIES, PAIR_ENTRIES = 2_000_000, 1_500_000, 1_500_000
#: Weight of the word's own probability against a context's count.
WEIGHT = 8.0
#: Codes of probabilities: 255 is 1, each step less is this much less in log10. 0 is none.
STEP = 9 / 254
#: Stands for the end of a text; no word has white space.
END = b" "


def squeeze(values: np.ndarray) -> bytes:
    """Unsigned 32- or 64-bit numbers by byte planes, compressed."""
    import zstandard

    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def expand(data: bytes, kind: str) -> np.ndarray:
    import zstandard

    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(flat.reshape(size, -1).T).view(kind).ravel()


# ---- texts as blocks of numbers


def _encode(batches):
    """Blocks of texts: ids, whether held out, lengths, local numbers of tokens; and the hashes of
    the local words, in order, with their counts among texts to learn from."""
    from xxhash import xxh64_intdigest

    task, blocks = TaskContext.get().partitionId(), 0
    number: dict[bytes, int] = {END: 0}
    ids: list[int | None] = []
    held: list[bool] = []
    lengths: list[int] = []
    tokens: list[np.ndarray] = []
    total = 0

    def block():
        stream = np.concatenate(tokens)
        learned = ~np.repeat(np.array(held), lengths)
        hashes = np.fromiter((xxh64_intdigest(w) for w in number), np.uint64, len(number))
        order = np.argsort(hashes)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        stream = place[stream]
        counts = np.bincount(stream[learned], minlength=len(order))
        # Frequent words get small numbers, which take little room.
        popular = np.argsort(-np.bincount(stream, minlength=len(order)), kind="stable")
        small = np.empty(len(popular), np.int64)
        small[popular] = np.arange(len(popular))
        columns = [
            pa.array([(task << 24) + blocks], pa.int64()),
            pa.array([ids], pa.list_(pa.int64())),
            pa.array([held], pa.list_(pa.bool_())),
            pa.array([squeeze(np.array(lengths, np.uint32))], pa.binary()),
            pa.array([squeeze(small[stream].astype(np.uint32))], pa.binary()),
            pa.array([squeeze(popular.astype(np.uint32))], pa.binary()),
            pa.array([hashes[order].tobytes()], pa.binary()),
            pa.array([squeeze(counts.astype(np.uint64))], pa.binary()),
            pa.array([int(place[0])], pa.int64()),
            pa.array([len(order)], pa.int64()),
            pa.array([len(stream)], pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, _BLOCK_NAMES)

    for batch in batches:
        for key, out, text in zip(
            batch.column("id").to_pylist(),
            batch.column("held_out").to_pylist(),
            texts(batch, "text"),
            strict=True,
        ):
            words = lower_words(text)
            for w in set(words):
                if w not in number:
                    number[w] = len(number)
            tokens.append(np.array([*map(number.__getitem__, words), 0], np.uint32))
            ids.append(key)
            held.append(out)
            lengths.append(len(words) + 1)
            total += len(words) + 1
            if total >= BLOCK_TOKENS:
                yield block()
                blocks, total, number = blocks + 1, 0, {END: 0}
                ids, held, lengths, tokens = [], [], [], []
    if ids:
        yield block()


_BLOCK_SCHEMA = (
    "block long, ids array<long>, held array<boolean>, lengths binary, tokens binary, popular binary, "
    "hashes binary, counts binary, end long, n_words long, n_tokens long"
)
_BLOCK_NAMES = [x.split()[0] for x in _BLOCK_SCHEMA.split(", ")]


# ---- counts of words


def _slices(values: np.ndarray, shards: int) -> np.ndarray:
    """Bounds of sorted hashes by shard: equal parts of the range of hashes."""
    width = (1 << 64) // shards + 1
    cuts = np.array([min(width * k, (1 << 64) - 1) for k in range(1, shards)], np.uint64)
    return np.concatenate([[0], np.searchsorted(values, cuts), [len(values)]])


def _send_words(batches, shards: int):
    for batch in batches:
        for block, hashes, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            values, numbers = np.frombuffer(hashes, np.uint64), expand(counts, "u8")
            bounds = _slices(values, shards).tolist()
            parts = [(k, a, b) for k, (a, b) in enumerate(zip(bounds, bounds[1:])) if a < b]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k for k, _, _ in parts], pa.int64()),
                    pa.array([block] * len(parts), pa.int64()),
                    pa.array([values[a:b].tobytes() for _, a, b in parts], pa.binary()),
                    pa.array([squeeze(numbers[a:b]) for _, a, b in parts], pa.binary()),
                ],
                ["shard", "block", "hashes", "counts"],
            )


_ANSWER = "block long, kind int, shard long, values binary, numbers binary, n_types long, n_all long, n_learned long, totals binary"


def _answer(rows: list[tuple]) -> pa.Table:
    names = [x.split()[0] for x in _ANSWER.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), *[pa.int64()] * 3, pa.binary()]
    return pa.table([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names)


def _count_words(table: pa.Table) -> pa.Table:
    """Totals of a shard's words; to each block the totals and numbers of the words it sent."""
    blocks, shard = table.column("block").to_pylist(), table.column("shard")[0].as_py()
    sent = [np.frombuffer(x, np.uint64) for x in table.column("hashes").to_pylist()]
    counts = np.concatenate([expand(x, "u8") for x in table.column("counts").to_pylist()])
    words, number = np.unique(np.concatenate(sent), return_inverse=True)
    totals = np.zeros(len(words), np.uint64)
    np.add.at(totals, number, counts)
    rows, at = [], 0
    for block, values in zip(blocks, sent, strict=True):
        own = number[at : at + len(values)]
        at += len(values)
        rows.append(
            (block, 1, shard, squeeze(totals[own]), squeeze(own.astype(np.uint32)), None, None, None, None)
        )
    known = int((totals > 0).sum())
    rows.append((None, 0, shard, None, None, known, len(words), int(totals.sum()), None))
    return _answer(rows)


# ---- counts of pairs


class _Block:
    """A block with the totals of its words, and its distinct pairs by shard."""

    def __init__(self, row: dict, answers: list[dict], offsets: np.ndarray, learned_tokens: int, shards: int):
        self.lengths = expand(row["lengths"], "u4").astype(np.int64)
        popular = expand(row["popular"], "u4").astype(np.int64)
        stream = popular[expand(row["tokens"], "u4").astype(np.int64)]
        own = sorted((a for a in answers if a["kind"] == 1), key=lambda a: a["shard"])
        self.totals = np.concatenate([expand(a["values"], "u8") for a in own]).astype(np.int64)
        numbers = np.concatenate(
            [offsets[a["shard"]] + expand(a["numbers"], "u4").astype(np.int64) for a in own]
        )
        self.stream = stream
        before = np.concatenate([[row["end"]], stream[:-1]])
        code = before << 32 | stream
        pairs, self.pair = np.unique(code, return_inverse=True)
        learned = ~np.repeat(np.array(row["held"]), self.lengths)
        counts = np.bincount(self.pair[learned], minlength=len(pairs))
        self.numbers, self.learned, self.shape = numbers, learned, (learned_tokens, shards)
        context, word = pairs >> 32, pairs & 0xFFFFFFFF
        shard = self._shard(numbers[context], numbers[word], self.totals[context])
        # Pairs are in order of their hashes, and so of their numbers in all blocks.
        order = np.argsort(shard.astype(np.min_scalar_type(shards)), kind="stable")
        self.order, self.shard = order, shard[order]
        self.context, self.word = numbers[context][order], numbers[word][order]
        self.counts, self.context_total = counts[order], self.totals[context][order]

    def _shard(self, context: np.ndarray, word: np.ndarray, total: np.ndarray) -> np.ndarray:
        learned_tokens, shards = self.shape
        # A context with so many tokens that it would fill a shard is spread by its words.
        wide = total * 4 * shards > learned_tokens
        key = context * 0x9E3779B1 + np.where(wide, word * 0x85EBCA77 + 1, 0)
        return ((key ^ key >> 29) & 0x7FFFFFFF) % shards

    def to_triples(self, answers: list[dict]) -> "_Block":
        """The same with the distinct triples in the place of pairs: learned pairs of a text are
        the contexts of the tokens ``at`` after them."""
        shards = self.shape[1]
        own = sorted((a for a in answers if a["kind"] == 2), key=lambda a: a["shard"])
        number, total = np.empty((2, len(self.order)), np.int64)
        number[self.order] = np.concatenate(
            [expand(a["numbers"], "u4").astype(np.int64) * shards + a["shard"] for a in own]
        )
        total[self.order] = np.concatenate([expand(a["totals"], "u8") for a in own]).astype(np.int64)
        inner = np.ones(len(self.stream), bool)
        inner[np.concatenate([[0], np.cumsum(self.lengths)[:-1]])] = False
        inner[1:] &= total[self.pair[:-1]] > 0
        self.at = np.flatnonzero(inner)
        before = self.pair[self.at - 1]
        self.before_total = total[before]
        triples, self.triple = np.unique(before << 32 | self.stream[self.at], return_inverse=True)
        counts = np.bincount(self.triple[self.learned[self.at]], minlength=len(triples))
        pair, word = triples >> 32, triples & 0xFFFFFFFF
        context, word, total = number[pair], self.numbers[word], total[pair]
        shard = self._shard(context, word, total)
        order = np.lexsort((word, context, shard))
        self.order, self.shard = order, shard[order]
        self.context, self.word = context[order], word[order]
        self.counts, self.context_total = counts[order], total[order]
        return self


def _send_grams(row, answers, shape, size):
    block = _Block(row, answers, *shape)
    if size == 3:
        block = block.to_triples(answers)
    cuts = np.flatnonzero(np.diff(block.shard, prepend=-1) != 0).tolist() + [len(block.shard)]
    rows = []
    for a, b in zip(cuts, cuts[1:]):
        first = np.flatnonzero(np.diff(block.context[a:b], prepend=-1) != 0)
        size = np.diff(np.concatenate([first, [b - a]]))
        rows.append(
            (
                int(block.shard[a]),
                row["block"],
                squeeze(block.context[a:b][first].astype(np.uint64)),
                squeeze(size.astype(np.uint32)),
                squeeze(block.context_total[a:b][first].astype(np.uint64)),
                squeeze(block.word[a:b].astype(np.uint64)),
                squeeze(block.counts[a:b].astype(np.uint32)),
            )
        )
    names = ["shard", "block", "contexts", "sizes", "totals", "words", "counts"]
    kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 5]
    return pa.table([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names)


def smoothed(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Codes of the part of a probability that comes from a pair's own count."""
    with np.errstate(divide="ignore"):
        code = 255 + np.rint(np.log10(counts / (totals + WEIGHT)) / STEP)
    return np.where(counts > 0, np.clip(code, 1, 255), 0).astype(np.uint8)


def probability(codes: np.ndarray) -> np.ndarray:
    return np.where(codes > 0, 10.0 ** ((codes.astype(np.float64) - 255) * STEP), 0.0)


def _by_pair(contexts: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The order by context and word. What came in order is merged, which is quick."""
    top = int(words.max(initial=0)) + 1
    if int(contexts.max(initial=0)) < (1 << 62) // top:
        return np.argsort(contexts * top + words, kind="stable")
    return np.lexsort((words, contexts))


def _by_shard(size: int, numbered: bool):
    """``_count_grams`` as a function of a shard's table."""

    def apply(table: pa.Table) -> pa.Table:
        return _count_grams(table, size, numbered)

    return apply


def _count_grams(table: pa.Table, size: int, numbered: bool) -> pa.Table:
    """A shard's trie out of all blocks' counts, asked for each pair (or triple) that a block has
    sent; with the pair's number and count if it is ``numbered`` to be a context itself."""
    blocks, shard = table.column("block").to_pylist(), table.column("shard")[0].as_py()
    column = {n: table.column(n).to_pylist() for n in ("contexts", "sizes", "totals", "words", "counts")}
    sizes = [expand(x, "u4").astype(np.int64) for x in column["sizes"]]

    def spread(name: str) -> np.ndarray:
        return np.concatenate(
            [np.repeat(expand(x, "u8").astype(np.int64), n) for x, n in zip(column[name], sizes, strict=True)]
        )

    contexts = spread("contexts")
    words = np.concatenate([expand(x, "u8").astype(np.int64) for x in column["words"]])
    counts = np.concatenate([expand(x, "u4").astype(np.int64) for x in column["counts"]])
    learned = np.flatnonzero(counts)
    order = learned[_by_pair(contexts[learned], words[learned])]
    c, w = contexts[order], words[order]
    first = np.flatnonzero((np.diff(c, prepend=-1) != 0) | (np.diff(w, prepend=-1) != 0))
    sums = np.add.reduceat(counts[order], first) if len(first) else np.zeros(0, np.int64)
    codes = smoothed(sums, spread("totals")[order[first]])
    trie = Trie.of(c[first], w[first], codes)
    del contexts, counts, learned, order, c, w, first
    with tempfile.TemporaryFile() as file:
        mapped = Trie.mapped(file, trie.write(file))
        del trie
        asked = np.concatenate([expand(x, "u8").astype(np.int64) for x in column["contexts"]])
        places = mapped.places(asked, np.concatenate(sizes), words)
        codes = np.zeros(len(places), np.uint8)
        codes[places >= 0] = mapped.codes[places[places >= 0]]
    totals = np.zeros(len(places) if numbered else 0, np.uint64)
    if numbered:
        totals[places >= 0] = sums[places[places >= 0]]
    rows, at = [], 0
    for block, own in zip(blocks, sizes, strict=True):
        n = int(own.sum())
        more = (None, None)
        if numbered:
            number = np.maximum(places[at : at + n], 0).astype(np.uint32)
            more = (squeeze(number), squeeze(totals[at : at + n]))
        rows.append((block, size, shard, codes[at : at + n].tobytes(), more[0], None, None, None, more[1]))
        at += n
    return _answer(rows)


# ---- scores


def _codes(block: _Block, answers: list[dict], size: int) -> np.ndarray:
    own = sorted((a for a in answers if a["kind"] == size), key=lambda a: a["shard"])
    codes = np.empty(len(block.order), np.uint8)
    codes[block.order] = np.frombuffer(b"".join(a["values"] for a in own), np.uint8)
    return codes


def _score(row, answers, shape, types, order):
    block = _Block(row, answers, *shape)
    codes = _codes(block, answers, 2)
    alone = (block.totals[block.stream] + 1) / (shape[1] + types + 1)
    context = np.concatenate([[row["end"]], block.stream[:-1]])
    pair = probability(codes)[block.pair]
    given = pair + WEIGHT / (block.totals[context] + WEIGHT) * alone
    if order == 3:
        block = block.to_triples(answers)
        triple = probability(_codes(block, answers, 3))[block.triple]
        given[block.at] = triple + WEIGHT / (block.before_total + WEIGHT) * given[block.at]
    starts = np.concatenate([[0], np.cumsum(block.lengths)[:-1]])
    known = np.add.reduceat((block.totals[block.stream] > 0).astype(np.int64), starts)
    return pa.table(
        [
            pa.array(row["ids"], pa.int64()),
            pa.array(row["held"], pa.bool_()),
            pa.array(block.lengths, pa.int64()),
            pa.array(known, pa.int64()),
            pa.array(np.full(len(starts), shape[1]), pa.int64()),
            pa.array(np.add.reduceat(np.log10(alone), starts), pa.float64()),
            pa.array(np.add.reduceat(np.log10(given), starts), pa.float64()),
        ],
        [x.split()[0] for x in _SCORES.split(", ")],
    )


_SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
    "base_score double, score double"
)


def _by_block(fn):
    """A function of a block and its answers, for cogrouped tables."""

    def apply(left: pa.Table, right: pa.Table) -> pa.Table:
        return fn(left.to_pylist()[0], right.to_pylist())

    return apply


def lm_scores(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    modulus: int = 7,
    held: int = 2,
    order: int = 2,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score.

    Learns from rows whose crc32(id as text) mod ``modulus`` is not ``held``. A token's probability
    is (c(before, token) + WEIGHT * p(token)) / (c(before) + WEIGHT) with p(token) = (c + 1) /
    (N + V + 1); texts begin after an end. With ``order`` 3 this is the p of (c(two before, token) +
    WEIGHT * p) / (c(two before) + WEIGHT) from a text's second token on.

    Texts become blocks of local word numbers, written once. A block sends its distinct words,
    and then its distinct pairs with counts, to shards that each hold a part of the model; a
    shard adds up the counts of all blocks, builds its trie and answers every pair that came. So
    nothing of the model is collected or broadcast, and what is shuffled are distinct words and
    pairs of a block, whatever the frequency of a word. A very frequent context is spread over
    shards by the words after it. Words are told apart by 64-bit hashes.

    Null and empty texts are the end alone. A null id is the empty text for crc32. Repeated rows
    count and give a row each. An empty table gives no rows.
    """
    if order not in (2, 3):
        raise ValueError(f"order is 2 or 3, not {order}")
    source = id_text(docs, id_col, text_col).withColumn("held_out", remainder(F.col("id"), modulus) == held)
    blocks = stored(map_batches(source, _encode, _BLOCK_SCHEMA))
    n_words, n_tokens = blocks.agg(
        F.coalesce(F.sum("n_words"), F.lit(0)), F.coalesce(F.sum("n_tokens"), F.lit(0))
    ).first()
    word_shards, pair_shards = 1 + n_words // WORD_ENTRIES, 1 + n_tokens // PAIR_ENTRIES
    sent = map_batches(
        blocks.select("block", "hashes", "counts"),
        lambda batches: _send_words(batches, word_shards),
        "shard long, block long, hashes binary, counts binary",
    )
    words = stored(sent.groupBy("shard").applyInArrow(_count_words, _ANSWER))
    stats = {
        r["shard"]: r
        for r in words.where("kind = 0").select("shard", "n_types", "n_all", "n_learned").collect()
    }  # one row for each shard of words
    types = sum(r["n_types"] for r in stats.values())
    learned = sum(r["n_learned"] for r in stats.values())
    every = [stats[k]["n_all"] if k in stats else 0 for k in range(word_shards)]
    offsets = np.concatenate([[0], np.cumsum(every)])
    shape = (offsets, learned, pair_shards)
    to_blocks = words.where("kind = 1")
    light = blocks.drop("hashes", "counts")
    answered = to_blocks
    for size in range(2, order + 1):
        grams = (
            light.groupBy("block")
            .cogroup(answered.groupBy("block"))
            .applyInArrow(
                _by_block(partial(_send_grams, shape=shape, size=size)),
                "shard long, block long, contexts binary, sizes binary, totals binary, words binary, counts binary",
            )
        )
        counted = grams.groupBy("shard").applyInArrow(_by_shard(size, size < order), _ANSWER)
        answered = answered.union(stored(counted))
    return (
        light.groupBy("block")
        .cogroup(answered.groupBy("block"))
        .applyInArrow(_by_block(lambda row, answers: _score(row, answers, shape, types, order)), _SCORES)
    )
