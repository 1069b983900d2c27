"""A convolutional text classifier over hashed word embeddings, trained in numpy."""

import zlib
from collections import Counter
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablebind.functions.names import col
from tablebind.llm.common import alphanumeric_words, id_text, map_batches, remainder, texts
from tablebind.plans.checkpoints import stored
from tablebind.plans.joins import BROADCAST_BYTES, byte_size

#: Rows of the embedding table, its width, filters of each width, widths in words.
BUCKETS, WIDTH, FILTERS, WIDTHS = 1 << 15, 16, 8, (1, 2, 3)
GRAM = 4
#: Labelled documents that a part of the training data has, about, and documents to learn from in
#: all: few rows are gone through up to EPOCHS times.
PART_ROWS, LEARNED = 8000, 20_000
EPOCHS, BATCH, RATE, PRIOR = 6, 32, 0.05, 3.0
#: Logits are counted in bins of 1 / BINS up to LARGEST; steps and their squares are summed up as
#: whole numbers of these units, so that no order of tasks changes them.
BINS, LARGEST, UNIT = 64, 64, 2.0**36
#: Texts of each class that a threshold needs: of fewer, one that is missed would weigh too much.
FEW = 20
#: Words whose embeddings a worker keeps, and words convolved at once.
KEPT_WORDS, AT_ONCE = 200_000, 100_000
#: Function words that tell languages apart.
FUNCTION_WORDS = {
    "en": "the of and to in is that with for on by",
    "de": "der die und von zu das mit ist ein für auf",
    "fr": "le les des et un une du est dans par qui",
    "es": "el los y en se con las del por una es",
}
_LANGUAGE = {w.encode(): k for k, ws in enumerate(FUNCTION_WORDS.values()) for w in ws.split()}


def features(word: bytes) -> list[int]:
    """Buckets of a word: of itself and of its runs of GRAM bytes."""
    grams = [word[k : k + GRAM] for k in range(len(word) - GRAM + 1)] if len(word) > GRAM else []
    return [zlib.crc32(b" " + word) % BUCKETS, *(zlib.crc32(g) % BUCKETS for g in grams)]


def language(words: list[bytes]) -> int:
    """The language with most function words, by number; one more if there is none."""
    counts = [0] * len(FUNCTION_WORDS)
    for w in words:
        k = _LANGUAGE.get(w)
        if k is not None:
            counts[k] += 1
    best = max(counts)
    return counts.index(best) if best else len(counts)


@dataclass
class Model:
    """Embeddings, filters by width and place, output weights, and a threshold by language."""

    table: np.ndarray
    filters: np.ndarray  # WIDTH x (places of all widths) x FILTERS
    bias: np.ndarray
    out: np.ndarray
    shift: float
    thresholds: np.ndarray

    def embed(self, words: list[list[int]]) -> np.ndarray:
        """The mean of the rows of each word's features."""
        if not words:
            return np.zeros((0, WIDTH), np.float32)
        sizes = np.array([len(w) for w in words])
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        flat = np.fromiter((f for w in words for f in w), np.int64, int(sizes.sum()))
        return np.add.reduceat(self.table[flat], starts, axis=0) / sizes[:, None].astype(np.float32)

    def convolved(self, x: np.ndarray) -> np.ndarray:
        """Filter values at each word; ``x`` ends in empty words."""
        z = x @ self.filters.reshape(WIDTH, -1)
        n, parts, at = len(x), [], 0
        for width in WIDTHS:
            total = z[:, at : at + FILTERS].copy()
            for place in range(1, width):
                lo = at + place * FILTERS
                total[: n - place] += z[place:, lo : lo + FILTERS]
            at += width * FILTERS
            parts.append(total)
        return np.concatenate(parts, axis=1)

    def logits(self, x: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Documents lie at starts to ends of ``x``, with max(WIDTHS) - 1 empty words after each."""
        bounds = np.stack([starts, ends], axis=1).ravel()
        best = np.maximum.reduceat(self.convolved(x), bounds[:-1], axis=0)[::2]
        return np.maximum(best + self.bias, 0) @ self.out + self.shift


def _layout(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of documents with room after each; an empty one has one empty word."""
    held = np.maximum(lengths, 1)
    starts = np.concatenate([[0], np.cumsum(held + max(WIDTHS) - 1)])[:-1]
    return starts, starts + held


def _counted(seen: np.ndarray, docs, labels, words) -> None:
    """Add to ``seen``, by class, the documents that have a feature."""
    for ids, y in zip(docs, labels, strict=True):
        present = {f for w in set(ids.tolist()) for f in words[w]}
        seen[int(y), list(present)] += 1


def _start(seen: np.ndarray, n: np.ndarray, rng) -> Model:
    """One dimension begins as the log odds of a feature among toxic texts, the others small."""
    n = np.maximum(n, 1)
    odds = np.log((seen[1] + PRIOR) / (n[1] + 2 * PRIOR)) - np.log((seen[0] + PRIOR) / (n[0] + 2 * PRIOR))
    table = rng.normal(0, 0.05, (BUCKETS, WIDTH)).astype(np.float32)
    table[:, 0] = odds
    filters = rng.normal(0, 0.1, (WIDTH, sum(WIDTHS), FILTERS)).astype(np.float32)
    filters[0, 0, 0] = 1
    size = len(WIDTHS) * FILTERS
    out = rng.normal(0, 0.1, size).astype(np.float32)
    out[0] = 2
    return Model(table, filters, np.zeros(size, np.float32), out, -1.0, np.zeros(len(FUNCTION_WORDS) + 1))


class _Learner:
    """A model that is fitted on small batches, with the sums of squares of its steps."""

    names = ("table", "filters", "bias", "out")

    def __init__(self, model: Model, squares: np.ndarray | None = None):
        self.model = Model(*[getattr(model, n).copy() for n in self.names], model.shift, model.thresholds)
        self.squares = {n: np.full_like(getattr(model, n), 1e-6, np.float64) for n in self.names}
        self.shift_square = 1e-6
        if squares is not None:
            at = 0
            for n, a in self.squares.items():
                a[...] = squares.ravel()[at : at + a.size].reshape(a.shape)
                at += a.size
            self.shift_square = float(squares.ravel()[at])

    def flat(self) -> tuple[np.ndarray, np.ndarray]:
        """Parameters and squares as rows of WIDTH values; the table's come first."""
        values = [*[getattr(self.model, n).ravel() for n in self.names], [self.model.shift]]
        squares = [*[a.ravel() for a in self.squares.values()], [self.shift_square]]
        found = [np.concatenate(x).astype(np.float64) for x in (values, squares)]
        return tuple(np.pad(x, (0, -len(x) % WIDTH)).reshape(-1, WIDTH) for x in found)

    def moved(self, steps: np.ndarray, squares: np.ndarray) -> "_Learner":
        """A learner whose parameters are further by ``steps``."""
        values, at = (self.flat()[0] + steps).ravel(), 0
        for n in self.names:
            a = getattr(self.model, n)
            a[...] = values[at : at + a.size].reshape(a.shape)
            at += a.size
        self.model.shift = float(values[at])
        return _Learner(self.model, squares)

    def learn(self, docs, labels: np.ndarray, words) -> None:
        """One step by the mean gradient of some documents."""
        model, squares = self.model, self.squares
        x, at, starts, ends = _packed(model, docs, words)
        maps = model.convolved(x)
        size = maps.shape[1]
        best = np.stack([s + maps[s:e].argmax(axis=0) for s, e in zip(starts, ends, strict=True)])
        hidden = np.maximum(maps[best, np.arange(size)] + model.bias, 0)
        error = 1 / (1 + np.exp(-np.clip(hidden @ model.out + model.shift, -30, 30))) - labels
        error = (error / len(docs)).astype(np.float32)
        grads = {"out": hidden.T @ error, "filters": np.zeros_like(model.filters)}
        back = error[:, None] * model.out * (hidden > 0)
        grads["bias"] = back.sum(axis=0)
        rows, steps = [], []
        place = 0
        for k, width in enumerate(WIDTHS):
            mine = slice(k * FILTERS, (k + 1) * FILTERS)
            for offset in range(width):
                where = best[:, mine] + offset
                grads["filters"][:, place] += np.einsum("df,dfw->wf", back[:, mine], x[where])
                rows.append(at[where].ravel())
                weights = model.filters[:, place].T
                steps.append((back[:, mine, None] * weights[None]).reshape(-1, WIDTH))
                place += 1
        rows, steps = np.concatenate(rows), np.concatenate(steps)
        real = rows >= 0
        if real.any():
            used, inverse = np.unique(rows[real], return_inverse=True)
            by_word = np.zeros((len(used), WIDTH))
            np.add.at(by_word, inverse, steps[real])
            sizes = np.array([len(words[w]) for w in used.tolist()])
            flat = np.fromiter((f for w in used.tolist() for f in words[w]), np.int64, int(sizes.sum()))
            buckets, inverse = np.unique(flat, return_inverse=True)
            g = np.zeros((len(buckets), WIDTH))
            np.add.at(g, inverse, np.repeat(by_word / sizes[:, None], sizes, axis=0))
            squares["table"][buckets] += g * g
            model.table[buckets] -= RATE * g / np.sqrt(squares["table"][buckets])
        for n, g in grads.items():
            squares[n] += g * g
            setattr(model, n, (getattr(model, n) - RATE * g / np.sqrt(squares[n])).astype(np.float32))
        self.shift_square += float(error.sum()) ** 2
        model.shift -= RATE * float(error.sum()) / self.shift_square**0.5


def _packed(model: Model, docs, words):
    """Embedded words of some documents, in layout, with the word at each place (-1: empty)."""
    starts, ends = _layout(np.array([len(d) for d in docs]))
    at = np.full(int(ends[-1]) + max(WIDTHS) - 1, -1, np.int64)
    for d, s in zip(docs, starts.tolist(), strict=True):
        at[s : s + len(d)] = d
    used, inverse = np.unique(at, return_inverse=True)
    rows = np.concatenate([np.zeros((1, WIDTH), np.float32), model.embed([words[w] for w in used[1:]])])
    return rows[inverse].astype(np.float32), at, starts, ends


def _numbered(data, number: dict[bytes, int], words: list[list[int]]):
    """Documents as numbers of their words; new words get a number and their features."""
    docs = []
    for ws in data:
        docs.append(np.array([number.setdefault(w, len(number)) for w in ws], np.int64))
    words.extend(features(w) for w in islice(number, len(words), None))
    return docs


def train(data: list[tuple[bytes, int]], seed: int = 0) -> Model:
    """Fit on a list of texts with labels 0 and 1; a fifth is kept to calibrate a threshold by
    language. ``fitted`` does the same for a table."""
    rng = np.random.default_rng(seed)
    split = [alphanumeric_words(t) for t, _ in data]
    words: list[list[int]] = []
    docs = _numbered(split, {}, words)
    labels = np.array([y for _, y in data], np.float64)
    held = np.arange(len(docs)) % 5 == 4
    fit = np.flatnonzero(~held)
    seen = np.zeros((2, BUCKETS))
    _counted(seen, [docs[k] for k in fit], labels[fit], words)
    learner = _Learner(_start(seen, np.bincount(labels[fit].astype(int), minlength=2), rng))
    for _ in range(EPOCHS):
        for part in np.array_split(rng.permutation(fit), max(1, len(fit) // BATCH)):
            if len(part):
                learner.learn([docs[k] for k in part], labels[part], words)
    kept = [split[k] for k in np.flatnonzero(held)]
    bins = Counter()
    if kept:
        logits, languages = _Scorer(learner.model).logits(kept)
        at = np.clip(np.round(logits * BINS), -BINS * LARGEST, BINS * LARGEST).astype(int)
        bins.update(zip(languages, at.tolist(), labels[held].astype(int).tolist(), strict=True))
    learner.model.thresholds[:] = thresholds(bins)
    return learner.model


def thresholds(bins: dict[tuple[int, int, int], int]) -> list[float]:
    """For each language the cut with fewest mistakes, both classes weighing the same, in the middle
    of the gap; a language with few texts uses those of all, and 0 is the cut if these are few. ``bins`` counts texts by language, bin
    of the logit, and label."""

    def cut(languages) -> float | None:
        counts: dict[int, list[int]] = {}
        for (k, at, y), n in bins.items():
            if k in languages:
                counts.setdefault(at, [0, 0])[y] += n
        s = np.array(sorted(counts))
        clean, toxic = (np.array([counts[a][y] for a in s.tolist()]) for y in (0, 1))
        if min(toxic.sum(), clean.sum()) < FEW:
            return None
        # below the cut: toxic texts are missed; above: clean texts are blamed
        missed = np.concatenate([[0], np.cumsum(toxic)]) / toxic.sum()
        blamed = 1 - np.concatenate([[0], np.cumsum(clean)]) / clean.sum()
        wrong = missed + blamed
        best = np.flatnonzero(wrong <= wrong.min() + 1e-12)
        k = int(best[len(best) // 2])
        return float((s[max(k - 1, 0)] + s[min(k, len(s) - 1)]) / 2 / BINS)

    every = range(len(FUNCTION_WORDS) + 1)
    overall = cut(every) or 0.0
    own = [cut({k}) for k in every]
    return [overall if x is None else x for x in own]


def _usable(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """(id, y) of the labels that may be learned from, once for each id: those whose id's crc32 is
    not divisible by 5."""
    usable = labels.select(col(id_col).cast("long").alias("id"), col(label_col).cast("int").alias("y"))
    usable = usable.where(F.col("id").isNotNull() & F.col("y").isin(0, 1) & (remainder(F.col("id"), 5) != 0))
    return stored(usable.groupBy("id").agg(F.max("y").alias("y")))


def _is_kept(id_col: Column) -> Column:
    """Whether a labelled text is kept apart for the thresholds."""
    return F.pmod(F.xxhash64(id_col), F.lit(5)) == 4


def training_rows(docs: DataFrame, usable: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(part, y, text) of every labelled text that is fitted, one for each id; a part's rows lie
    together, in an order that only depends on them."""
    source = id_text(docs, id_col, text_col).where("text IS NOT NULL AND id IS NOT NULL")
    source = source.where((remainder(F.col("id"), 5) != 0) & ~_is_kept(F.col("id")))
    few = byte_size(usable) <= BROADCAST_BYTES
    found = source.join(F.broadcast(usable) if few else usable, "id")
    parts = 1 + usable.count() // PART_ROWS
    found = found.repartition(parts, "id").groupBy("id").agg(F.max("text").alias("text"), F.max("y").alias("y"))
    found = found.withColumn("part", F.pmod(F.hash("id"), F.lit(parts)))
    found = found.sortWithinPartitions("part", F.xxhash64("id", F.lit(1)), "id")
    return stored(found.select("part", "y", "text"))


def fitted(rows: DataFrame, n: np.ndarray, seed: int = 0) -> Model:
    """Fit on all of ``rows`` (part, y, text), ``n`` of each class.

    One pass counts features. Then each part is learned from by a copy of the model, and the mean of
    the copies is the next model; a feature's, of the copies that met it. Only sums of the size of
    the model come to the driver.
    """

    def count(batches):
        seen = np.zeros((2, BUCKETS))
        for batch in batches:
            words: list[list[int]] = []
            docs = _numbered([alphanumeric_words(x) for x in texts(batch, "text")], {}, words)
            _counted(seen, docs, batch.column("y").to_pylist(), words)
        for y in (0, 1):
            at = np.flatnonzero(seen[y])
            columns = [np.full(len(at), y), at, seen[y][at].astype(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["y", "at", "n"])

    seen = np.zeros((2, BUCKETS))
    counted = map_batches(rows.select("y", "text"), count, "y long, at long, n long")
    for y, at, times in counted.groupBy("y", "at").agg(F.sum("n")).collect():  # two for each bucket at most
        seen[y, at] = times
    learner = _Learner(_start(seen, n, np.random.default_rng(seed)))
    values = [f"{x}{k}" for x in "vs" for k in range(WIDTH)]
    for _ in range(min(EPOCHS, max(1, -(-LEARNED // max(int(n.sum()), 1))))):
        shared = rows.sparkSession.sparkContext.broadcast(learner.flat() + (learner.model,))

        def learn(batches, shared=shared):
            before, old_squares, model = shared.value

            def told(copy):
                after, squares = copy.flat()
                at = np.flatnonzero((squares != old_squares).any(axis=1))
                for a in range(0, len(at), 4096):
                    here = at[a : a + 4096]
                    found = np.concatenate([after[here] - before[here], squares[here] - old_squares[here]], axis=1)
                    found = np.rint(found * UNIT).astype(np.int64)
                    columns = [pa.array(here, pa.int64()), *[pa.array(c) for c in found.T]]
                    yield pa.RecordBatch.from_arrays(columns, ["at", *values])

            part, copy, waiting, number, words = None, None, [], {}, []

            def go(most: int):
                while waiting and len(waiting) >= most:
                    some = waiting[:BATCH]
                    del waiting[:BATCH]
                    if len(number) > KEPT_WORDS:
                        number.clear()
                        words.clear()
                    docs = _numbered([ws for ws, _ in some], number, words)
                    copy.learn(docs, np.array([y for _, y in some], np.float64), words)

            for batch in batches:
                columns = batch.column("part").to_pylist(), batch.column("y").to_pylist(), texts(batch, "text")
                for p, y, text in zip(*columns, strict=True):
                    if p != part:
                        if copy is not None:
                            go(1)
                            yield from told(copy)
                        part, copy = p, _Learner(model, old_squares)
                    waiting.append((alphanumeric_words(text), y))
                    go(BATCH)
            if copy is not None:
                go(1)
                yield from told(copy)

        schema = ", ".join(f"{c} long" for c in ["at", *values])
        steps = map_batches(rows, learn, schema).groupBy("at")
        steps = steps.agg(F.count("*").alias("copies"), *[F.sum(c).alias(c) for c in values])
        moved, squares = np.zeros_like(shared.value[0]), shared.value[1].copy()
        for r in steps.collect():  # one for each row of the model
            mean = np.array(r[2:], np.float64) / UNIT / r["copies"]
            moved[r["at"]], squares[r["at"]] = mean[:WIDTH], squares[r["at"]] + mean[WIDTH:]
        learner = learner.moved(moved, squares)
        shared.unpersist()
    return learner.model


class _Scorer:
    """A model with the embeddings of words met so far."""

    def __init__(self, model: Model):
        self.model, self.number = model, {}
        self.rows = np.zeros((1, WIDTH), np.float32)

    def logits(self, docs: list[list[bytes]]) -> tuple[np.ndarray, list[int]]:
        """Before thresholds, and the languages."""
        found, first = np.zeros(len(docs)), 0
        while first < len(docs):
            last, n = first, 0
            while last < len(docs) and (last == first or n + len(docs[last]) <= AT_ONCE):
                n += len(docs[last])
                last += 1
            found[first:last] = self._some(docs[first:last])
            first = last
        return found, [language(d) for d in docs]

    def scores(self, docs: list[list[bytes]]) -> np.ndarray:
        logits, languages = self.logits(docs)
        return 1 / (1 + np.exp(-np.clip(logits - self.model.thresholds[languages], -500, 500)))

    def _some(self, docs: list[list[bytes]]) -> np.ndarray:
        if len(self.number) > KEPT_WORDS:
            self.number, self.rows = {}, self.rows[:1]
        number = self.number
        new = [w for w in {w for d in docs for w in d} if w not in number]
        if new:
            self.rows = np.concatenate([self.rows, self.model.embed([features(w) for w in new])])
            number.update(zip(new, range(len(number) + 1, len(number) + 1 + len(new)), strict=True))
        starts, ends = _layout(np.array([len(d) for d in docs]))
        at = np.zeros(int(ends[-1]) + max(WIDTHS) - 1, np.int64)
        for d, s in zip(docs, starts.tolist(), strict=True):
            at[s : s + len(d)] = [number[w] for w in d]
        return self.model.logits(self.rows[at], starts, ends)


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    The classifier learns from all labelled texts whose id's crc32 is not divisible by 5: four
    fifths of them are fitted, part by part in Spark's tasks, a fifth gives the thresholds. Its
    size is fixed; it is broadcast. A score depends on the text alone: the language whose
    threshold makes 0.5 is told by the text's function words.

    Null and empty texts get the score of a text without words. Labels other than 0 and 1, null
    ids and labels without a text are not learned from; an id that is labelled twice counts once.
    Without labels of both classes every score is 0. Repeated rows each give a row.
    """
    source = id_text(docs, id_col, text_col).withColumn("held_out", remainder(F.col("id"), 5) == 0)
    usable = _usable(labels, id_col, label_col)
    rows = training_rows(docs, usable, id_col, text_col)
    n = np.zeros(2, np.int64)
    for y, times in rows.groupBy("y").count().collect():
        n[y] = times
    if not n.all():
        return source.select(
            F.col("id").alias("doc_id"), "held_out", F.lit(0.0).alias("score"), F.lit(0).alias("predicted")
        )
    shared = docs.sparkSession.sparkContext.broadcast(fitted(rows, n))

    def score(batches):
        scorer = _Scorer(shared.value)
        for batch in batches:
            logits, languages = scorer.logits([alphanumeric_words(x) for x in texts(batch, "text")])
            known = pa.array([x is not None for x in batch.column("text").to_pylist()], pa.bool_())
            columns = [batch.column("id"), batch.column("held_out"), known]
            columns += [pa.array(logits, pa.float64()), pa.array(languages, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "held_out", "known", "logit", "language"])

    schema = "id long, held_out boolean, known boolean, logit double, language int"
    scored = stored(map_batches(source, score, schema))
    at = F.round(F.greatest(F.least(F.col("logit"), F.lit(LARGEST)), F.lit(-LARGEST)) * BINS).cast("int")
    kept = scored.where(F.col("known") & ~F.col("held_out") & _is_kept(F.col("id"))).join(usable, "id")
    bins = kept.groupBy("language", at.alias("at"), "y").count().collect()  # of a fixed number
    cuts = thresholds({(r[0], r[1], r[2]): r[3] for r in bins})
    cut = F.array(*[F.lit(x) for x in cuts])[F.col("language")]
    score_of = 1 / (1 + F.exp(F.greatest(F.least(cut - F.col("logit"), F.lit(500.0)), F.lit(-500.0))))
    return scored.select(
        F.col("id").alias("doc_id"), "held_out", score_of.alias("score"), (score_of >= 0.5).cast("int").alias("predicted")
    )
