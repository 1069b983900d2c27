"""Links between documents of similar word shingles, by PartEnum signatures.

Sets of shingles are taken in classes of similar size. In a class the domain of all shingles is
dealt into parts and each part into CELLS cells. Similar sets differ in so few shingles that some
parts hold at most OUT differences and agree in all other cells. So for each part the subsets of
CELLS - OUT cells are enumerated, and the hash of what a set has in such a subset is a signature;
similar sets share one.

A class has more parts than that needs, so similar sets share several signatures. Each set may
leave out as many less one, as long as all sets leave out the first ones by one order of all
signatures. Those of crowded buckets (passages that many documents have) go first, then those with
few shingles behind them, which tell least.
"""

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

#: Cells of a part, and those that a signature leaves out: the differences a part may hold.
CELLS, OUT = 2, 1
SUBSETS = np.array(list(combinations(range(CELLS), CELLS - OUT)))
#: Parts for each one that is needed, and some more for small sets.
PARTS, MORE = 2, 2
#: Sizes of classes grow by this factor.
CLASS = 2
#: Buckets of signatures that are counted, and the least multiple of the mean that is crowded.
BUCKETS, CROWDED = 65_536, 4
#: Rounds in which every set meets one other set for each of its marks, before all others.
ROUNDS = 1
#: Sets of a mark that the others meet at first if there are more; then they meet GROW times as many.
SOME, GROW = 2048, 4
#: Words of 64 bits in a sketch of a set: for each bit, whether it has an odd number of shingles there.
SKETCH = 8

M1, M2, M3 = (np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15))


#: Odd factors for the words of a shingle by their place.
PLACES = [np.uint64((0x9E3779B97F4A7C15 * (2 * k + 3) | 1) % (1 << 64)) for k in range(8)]


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit numbers made to look random, one to one."""
    x = (x ^ (x >> np.uint64(30))) * M1
    x = (x ^ (x >> np.uint64(27))) * M2
    return x ^ (x >> np.uint64(31))


def shingle_set(text: bytes, size: int) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes; the whole text if it is shorter."""
    from xxhash import xxh64_digest

    words = lower_words(text)
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.frombuffer(b"".join(map(xxh64_digest, words)), np.uint64)
    n = max(len(words) - size + 1, 1)
    length = min(size, len(words))
    # The number of words counts, so that a short text never equals a shingle.
    out = np.full(n, length, np.uint64)
    for k in range(length):
        out += hashes[k : k + n] * PLACES[k % len(PLACES)]
        if k % len(PLACES) == len(PLACES) - 1:
            out = mixed(out)
    out = mixed(out)
    out.sort()
    return out[np.concatenate([[True], out[1:] != out[:-1]])]


class Classes:
    """Size classes of a threshold, and how many parts and signatures their sets have."""

    def __init__(self, percent: int):
        self.percent = percent

    def of(self, n: int) -> int:
        """The class of a set: the power of CLASS that its size begins."""
        c = 0
        while CLASS ** (c + 1) <= n:
            c += 1
        return c

    def largest_partner(self, n: int) -> int:
        return n * 100 // self.percent

    def differences(self, a: int, b: int) -> int:
        """The most shingles in only one of two similar sets of such sizes."""
        return (a + b) * (100 - self.percent) // (100 + self.percent)

    def parts(self, c: int) -> int:
        largest = CLASS ** (c + 1) - 1
        return (self.differences(largest, largest) // (OUT + 1) + 1) * PARTS + MORE

    def shared(self, n: int, c: int) -> int:
        """Signatures that a set of ``n`` shares with any similar one in class ``c``, at least.

        A difference changes the subsets that have its cell, most in a part without another.
        """
        largest = CLASS ** (c + 1) - 1
        differences = self.differences(n, min(self.largest_partner(n), largest))
        changed = len(SUBSETS) * (CELLS - OUT) // CELLS
        return self.parts(c) * len(SUBSETS) - differences * changed


def all_signatures(shingles: np.ndarray, classes: Classes):
    """Class, signatures and shingles behind each, for a set's class and the next if it has partners
    there."""
    n = len(shingles)
    first = classes.of(n)
    for c in range(first, classes.of(classes.largest_partner(n)) + 1):
        parts = classes.parts(c)
        dealt = mixed(shingles ^ mixed(np.full(1, c, np.uint64)))
        cell = ((dealt >> np.uint64(32)) * np.uint64(parts * CELLS) >> np.uint64(32)).astype(np.int64)
        counts = np.bincount(cell, minlength=parts * CELLS).reshape(parts, CELLS)
        sums = np.zeros(parts * CELLS, np.uint64)
        np.add.at(sums, cell, mixed(dealt + M3))
        sums = sums.reshape(parts, CELLS)
        place = np.arange(parts * len(SUBSETS), dtype=np.uint64).reshape(parts, len(SUBSETS))
        behind = counts[:, SUBSETS].sum(axis=2).ravel()
        marks = mixed(sums[:, SUBSETS].sum(axis=2, dtype=np.uint64) ^ mixed(place * M3 + np.uint64(c))).ravel()
        yield c, marks, behind


def signatures(shingles: np.ndarray, classes: Classes, levels: np.ndarray) -> np.ndarray:
    """The signatures a set is found by; ``levels`` tells how crowded a bucket is."""
    found = []
    for c, marks, behind in all_signatures(shingles, classes):
        level = levels[marks & np.uint64(BUCKETS - 1)].astype(np.uint64)
        # One number to order by: crowded first, then few shingles, then by hash.
        order = (np.uint64(63) - level) << np.uint64(58) | np.minimum(behind, 1023).astype(np.uint64) << np.uint64(48)
        order |= marks >> np.uint64(16)
        left_out = classes.shared(len(shingles), c) - 1
        found.append(marks[np.argpartition(order, left_out)[left_out:]])
    return np.concatenate(found)


def _set_key(shingles: np.ndarray) -> int:
    from xxhash import xxh64_intdigest

    return xxh64_intdigest(shingles.tobytes()) - (1 << 63)


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Sets that differ in d shingles have sketches that differ in d bits at most."""
    odd = np.bincount((shingles % np.uint64(64 * SKETCH)).astype(np.int64), minlength=64 * SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return id_text(docs, id_col, text_col).withColumn("row_hash", F.xxhash64(F.coalesce("text", F.lit(""))))


def described(docs: DataFrame, id_col: str, text_col: str, size: int, percent: int) -> DataFrame:
    """Each row's id, row_hash (of the text), n, key and sketch of its set; and from every task a row
    with the number of its signatures (n), and the buckets that hold many of them."""
    classes = Classes(percent)
    names = ["id", "row_hash", "n", "key", "sketch", "buckets", "counts"]
    kinds = [pa.int64()] * 4 + [pa.list_(pa.int64())] * 3

    def run(batches):
        counts = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            sets = [shingle_set(x, size) for x in texts(batch, "text")]
            marks = [m for x in sets if len(x) for _, m, _ in all_signatures(x, classes)]
            if marks:
                at = np.concatenate(marks) & np.uint64(BUCKETS - 1)
                counts += np.bincount(at.astype(np.int64), minlength=BUCKETS)
            columns = [
                batch.column("id"),
                batch.column("row_hash"),
                pa.array([len(x) for x in sets], pa.int64()),
                pa.array([_set_key(x) for x in sets], pa.int64()),
                pa.array([sketch(x) for x in sets], kinds[4]),
                *[pa.nulls(len(sets), k) for k in kinds[5:]],
            ]
            yield pa.RecordBatch.from_arrays(columns, names)
        many = np.flatnonzero(counts > CROWDED / 2 * counts.mean() + 4)
        values = [[None], [None], [int(counts.sum())], [None], [None], [many], [counts[many]]]
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names)

    source = _source(docs, id_col, text_col)
    schema = "id long, row_hash long, n long, key long, sketch array<long>, buckets array<long>, counts array<long>"
    return map_batches(source, run, schema)


def _levels(rows: DataFrame) -> np.ndarray:
    """How crowded each bucket of signatures is: the logarithm of its count by the mean.

    Summed up over the tasks in which it is crowded. This steers the order of signatures only, which
    any numbers keep right.
    """
    told = rows.where("key IS NULL")
    mean = (told.agg(F.sum("n")).first()[0] or 0) / BUCKETS
    counts = told.select(F.explode(F.arrays_zip("buckets", "counts")).alias("x"))
    counts = counts.groupBy("x.buckets").agg(F.sum("x.counts").alias("count"))
    levels = np.zeros(BUCKETS, np.int8)
    # At most BUCKETS / CROWDED of them.
    for r in counts.where(F.col("count") > CROWDED * mean + 100).collect():
        levels[r["buckets"]] = int(np.log2(r["count"] / mean))
    return levels


def _met(batches):
    """Rows sorted by mark and key: those of marks that more than one set has, once each."""
    rest = np.zeros((2, 0), np.int64)

    def several(rows: np.ndarray):
        # Rows with equal sets give the same.
        fresh = np.ones(rows.shape[1], bool)
        fresh[1:] = (rows[:, 1:] != rows[:, :-1]).any(axis=0)
        rows = rows[:, fresh]
        same = rows[0, 1:] == rows[0, :-1]
        kept = np.zeros(rows.shape[1], bool)
        kept[1:] |= same
        kept[:-1] |= same
        return pa.RecordBatch.from_arrays([pa.array(rows[0, kept]), pa.array(rows[1, kept])], ["mark", "key"])

    for batch in batches:
        rows = np.concatenate([rest, np.stack([batch.column(n).to_numpy() for n in ("mark", "key")])], axis=1)
        cut = int((rows[0] == rows[0, -1]).argmax())  # sorted: where the last mark begins
        rest = rows[:, cut:]
        if cut:
            yield several(rows[:, :cut])
    if rest.shape[1]:
        yield several(rest)


def _postings(docs: DataFrame, text_col: str, size: int, percent: int, levels: np.ndarray) -> DataFrame:
    """(mark, key) of all marks that several sets share, and perhaps of a few others.

    Marks of crowded buckets are combined before they are shuffled, so no task gets a mark of very
    many rows.
    """
    classes = Classes(percent)

    def run(batches):
        for batch in batches:
            sets = [x for x in (shingle_set(x, size) for x in texts(batch, "text")) if len(x)]
            marks = [signatures(x, classes, levels) for x in sets]
            keys = np.array([_set_key(x) for x in sets], np.int64).repeat([len(x) for x in marks])
            marks = np.concatenate([np.zeros(0, np.uint64), *marks])
            hot = levels[marks & np.uint64(BUCKETS - 1)] > 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(marks.view(np.int64)), pa.array(keys), pa.array(hot)], ["mark", "key", "hot"]
            )

    source = docs.select(col(text_col).cast("string").alias("text"))
    listed = stored(map_batches(source, run, "mark long, key long, hot boolean"))
    ordered = listed.where("NOT hot").select("mark", "key").repartition("mark")
    ordered = ordered.sortWithinPartitions("mark", "key")
    crowded = listed.where("hot").select("mark", "key").distinct()
    return stored(ordered.mapInArrow(_met, "mark long, key long").union(crowded))


def _shingle_sets(docs: DataFrame, wanted: DataFrame, text_col: str, size: int) -> DataFrame:
    """(key, shingles) of the wanted (row_hash, key)."""

    def run(batches):
        for batch in batches:
            sets = [shingle_set(x, size).view(np.int64) for x in texts(batch, "text")]
            keys = pa.array([_set_key(x.view(np.uint64)) for x in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([keys, pa.array(sets, pa.list_(pa.int64()))], ["key", "shingles"])

    source = docs.select(col(text_col).cast("string").alias("text"))
    source = source.withColumn("row_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    once = lookup(source, wanted, ["row_hash"], "left_semi").groupBy("row_hash").agg(F.first("text").alias("text"))
    return map_batches(once, run, "key long, shingles array<long>").dropDuplicates(["key"])


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are similar enough, by their whole sets."""
    found = pairs.join(sets.withColumnsRenamed({"key": "a", "shingles": "x"}), "a")
    found = found.join(sets.withColumnsRenamed({"key": "b", "shingles": "y"}), "b")
    both = F.size(F.array_intersect("x", "y"))
    union = F.size("x") + F.size("y") - both
    return found.where(100 * both.cast("long") >= percent * union).select("a", "b")


def _classes(sets: DataFrame, links: DataFrame) -> DataFrame:
    """(key, c): sets with the class that the links join them to, at first their own."""
    roots = checkpointed(components(links)).withColumnsRenamed({"node": "key", "root": "r"})
    found = sets.join(roots, "key", "left")
    return stored(found.select("key", F.coalesce("r", "key").alias("c")))


def _near(pairs: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    """The pairs (key, key2) that are similar enough as far as sizes and sketches tell."""
    new_names = {x: x + "2" for x in bits.columns}
    found = pairs.join(bits, "key").join(bits.withColumnsRenamed(new_names), "key2")
    return found.where(_alike(percent)).where(_few_bits(percent)).select("key", "key2")


def _alike(percent: int) -> str:
    return f"100 * least(n, n2) >= {percent} * greatest(n, n2)"


def _few_bits(percent: int) -> str:
    differ = " + ".join(f"bit_count(s{k} ^ s{k}2)" for k in range(SKETCH))
    return f"({differ}) * {100 + percent} <= (n + n2) * {100 - percent}"


def links(docs: DataFrame, sets: DataFrame, text_col: str, size: int, percent: int, levels: np.ndarray) -> DataFrame:
    """Links (a, b) between keys that connect all sets (key, row_hash, n) that are similar.

    First each set meets one other of each of its groups, the one that shares most marks with most
    sets: of a text and its near copies that is a text near the middle, which most others are
    similar to. So copies become a class by about as many pairs as there are copies. Then all
    pairs that share a mark and are not yet in one class are verified; sets that are in one class
    by then need no more links among them. In large groups that is done with a part of the partners
    first, so a set that is similar to many finds its class by a few of them. Most pairs that are
    too different are told by their sketches.
    """
    postings = _postings(docs, text_col, size, percent, levels)
    sizes = stored(postings.groupBy("mark").agg(F.count("*").alias("size")).where("size > 1"))
    met = postings.join(sizes, "mark").groupBy("key").agg(F.sum("size").alias("met"))
    whole = stored(sets.join(met, "key"))
    shingles = stored(_shingle_sets(docs, whole.select("row_hash").distinct(), text_col, size))
    bits = whole.select("key", "n", *[F.col("sketch")[k].alias(f"s{k}") for k in range(SKETCH)])
    # Ties go the same way in all groups.
    rank = F.col("met") * 65536 + F.pmod(F.xxhash64("key"), F.lit(65536))
    state = whole.select("key", F.col("key").alias("c"), rank.alias("rank"))
    found = None
    turn, parts = 0, 0
    while parts != 1:
        here = stored(postings.join(state, "key"))
        groups = here.groupBy("mark").agg(
            F.min("c").alias("low"),
            F.max("c").alias("high"),
            F.max_by("key", "rank").alias("key2"),
            F.max_by("c", "rank").alias("c2"),
            F.count("*").alias("size"),
        )
        open_marks = stored(groups.where("low <> high").select("mark", "key2", "c2", "size"))
        largest = open_marks.agg(F.max("size")).first()[0]
        if largest is None:
            break
        if turn < ROUNDS:
            pairs = here.join(open_marks.drop("size"), "mark").where("c <> c2").select("key", "key2").distinct()
            pairs = _near(pairs, bits, percent)
        else:
            if not parts:
                parts = 1
                while largest > SOME * parts:
                    parts *= GROW
            else:
                parts //= GROW
            # The largest class of a mark meets all others, and those meet each other. The sketches
            # are compared inside the join, so most pairs are never rows.
            here = here.join(open_marks.select("mark"), "mark", "left_semi").drop("rank").join(bits, "key")
            counted = here.groupBy("mark", "c").count()
            main = counted.groupBy("mark").agg(F.max(F.struct("count", "c")).alias("m"))
            here = here.join(main.select("mark", F.col("m.c").alias("main")), "mark")
            all_others = here.withColumnsRenamed({x: x + "2" for x in ("c", *bits.columns)})
            if parts > 1:
                all_others = all_others.where(F.pmod(F.xxhash64("key2"), F.lit(parts)) == 0)
            pairs = here.where("c <> main").drop("main").join(all_others, "mark")
            pairs = pairs.where("c <> c2 AND (c2 = main OR key < key2)")
            pairs = pairs.where(_alike(percent)).where(_few_bits(percent))
        pairs = pairs.select(F.least("key", "key2").alias("a"), F.greatest("key", "key2").alias("b"))
        new = _verified(stored(pairs.distinct()), shingles, percent)
        found = stored(new if found is None else found.union(new))
        turn += 1
        if parts != 1:
            # Another set of each group next time.
            state = _classes(whole, found).withColumn("rank", F.xxhash64("key", F.lit(turn)))
    empty = sets.select(F.col("key").alias("a"), F.col("key").alias("b")).where("false")
    return empty if found is None else found


def similar_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 5,
    percent: int = 80,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id and row_hash (of the text).

    Documents link when 100 * intersection >= percent * union of their shingle sets; component_id
    is the smallest id reachable. Equal sets are one entry of the search. The search is exact but
    for 64-bit hashes of words, shingles and sets; there is no cap on candidates.

    Null and empty texts and those without words have no shingles, link with nothing and are a
    component of their own: their own id, null for a null id. A text of fewer than ``size`` words is
    one shingle. Rows with one id give a row each and, if they have words, may be in different
    components. A null id never is a component's smallest; a component of null ids has a null
    component_id. An empty table gives no rows. Other columns are not read. ``percent`` is 50 to 100.
    """
    if not 50 <= percent <= 100:
        raise ValueError("percent must be 50 to 100")
    whole = stored(described(docs, id_col, text_col, size, percent))
    rows = whole.where("key IS NOT NULL").drop("buckets", "counts")
    # Equal sets: one text stands for all.
    first = stored(
        rows.where("n > 0")
        .groupBy("key")
        .agg(F.min("id").alias("least"), F.min("row_hash").alias("row_hash"), F.max("n").alias("n"), F.first("sketch").alias("sketch"), F.count("*").alias("copies"))
    )
    sets = first.select("key", "row_hash", "n", "sketch")
    found = checkpointed(components(links(docs, sets, text_col, size, percent, _levels(whole))))
    roots = first.join(found.withColumnRenamed("node", "key"), "key")
    least = roots.groupBy("root").agg(F.min("least").alias("joint"))
    joined = roots.join(least, "root").select("key", "joint")
    # Only sets whose component's id isn't that of each row itself need to be looked up.
    named = stored(
        first.join(joined, "key", "left")
        .where("joint IS NOT NULL OR copies > 1")
        .select("key", F.coalesce("joint", "least").alias("joint"), F.lit(True).alias("told"))
    )
    return lookup(rows, named, ["key"], "left").select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.when(F.col("told") & (F.col("n") > 0), F.col("joint")).otherwise(F.col("id")).alias("component_id"),
        "row_hash",
    )
