"""Repair of conversation structure, solved once for every distinct ending of a conversation.

A conversation becomes a signature with one letter a row: its role and its fault. What the rest of
a conversation costs depends on its remaining signature only, so signatures are an automaton that
shares suffixes: a node is a distinct suffix. Distinct signatures are sorted from their end; the
conversations that pass a node are then neighbours, each node is solved once when it is first met,
and a task holds the nodes of one signature at a time.
"""

import hashlib
import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tablebind.functions.names import col
from tablebind.plans.checkpoints import checkpointed, stored
from tablebind.plans.joins import lookup
from tablebind.plans.ordered import PART, POSITION, place_rows

#: The letter of a row that has to go; others are s, u, a or o (another role), upper case if truncated.
GONE = "d"
ROLES = {"u": "user", "a": "assistant"}

#: Grammar states: nothing yet, after the system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
#: What a state is followed by when a user or assistant row comes next.
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
RAISED = {USER: "u", ASSISTANT: "a"}

RELABEL, DELETE, INSERT, UNENDED = 1, 2, 5, 5

#: For each state: the cost of the rest, the first edit and the state after it.
Node = list[tuple[float, str, int]]


def _with_inserts(plain: Node) -> Node:
    """A node of which only edits that use up a row are known, with insertions tried as well."""
    user, assistant = plain[USER][0], plain[ASSISTANT][0]
    cost = [
        plain[START][0],
        plain[SYSTEM][0],
        min(user, assistant + INSERT),
        min(assistant, user + INSERT),
    ]
    node = []
    for state in (START, SYSTEM, USER, ASSISTANT):
        inserted = (cost[NEXT[state]] + INSERT, "I", NEXT[state])
        node.append(min(plain[state], inserted))
    return node


#: The node of the empty suffix: nothing, or an answer, may be last.
LAST = _with_inserts([(0, "", START), (math.inf, "", SYSTEM), (math.inf, "", USER), (0, "", ASSISTANT)])


def solved(letter: str, rest: Node) -> Node:
    """The node of a suffix that begins with ``letter`` and goes on as ``rest``.

    Every edit leads to one state, so of equal costs the least first letter gives the least audit.
    """
    more = UNENDED if letter.isupper() else 0
    role = letter.lower()
    plain = []
    for state in (START, SYSTEM, USER, ASSISTANT):
        edits = [(DELETE + rest[state][0], "D", state)]
        if letter != GONE:
            to = NEXT[state]
            if RAISED[to] == role:
                edits.append((more + rest[to][0], "K", to))
            elif state == START and role == "s":
                edits.append((more + rest[SYSTEM][0], "K", SYSTEM))
            if RAISED[to] != role:
                edits.append((RELABEL + more + rest[to][0], "R", to))
        plain.append(min(edits))
    return _with_inserts(plain)


def repairs(batches):
    """Cost and audit of signatures that come sorted by their reversal."""
    path, nodes = "", [LAST]
    for batch in batches:
        costs, audits = [], []
        for signature in batch.column("reversed").to_pylist():
            shared = 0
            for x, y in zip(path, signature):
                if x != y:
                    break
                shared += 1
            del nodes[shared + 1 :]
            for letter in signature[shared:]:
                nodes.append(solved(letter, nodes[-1]))
            path = signature
            at, state, audit = len(signature), START, []
            costs.append(int(nodes[at][START][0]))
            while edit := nodes[at][state][1]:
                audit.append(edit)
                state, at = nodes[at][state][2], at - (edit != "I")
            audits.append("".join(audit))
        yield pa.RecordBatch.from_arrays(
            [batch.column("reversed"), pa.array(costs, pa.int64()), pa.array(audits, pa.string())],
            ["reversed", "cost", "audit"],
        )


def repaired_hashes(batches, kind: pa.DataType):
    """SHA-256 of repaired conversations. Rows come by conversation and position; position -1 holds
    the audit. A row is hashed as it comes, so a conversation of any length needs no memory."""
    audit, at, state, digest, some = "", 0, START, None, False
    conv = None

    def put(role: str, text: str):
        nonlocal some
        digest.update((("\n" if some else "") + role + ":" + text).encode())
        some = True

    def insert():
        nonlocal at, state
        while audit[at : at + 1] == "I":
            state, at = NEXT[state], at + 1
            put(ROLES[RAISED[state]], "")

    for batch in batches:
        convs, hashes = [], []
        columns = [batch.column(c).to_pylist() for c in ("conv", "at", "role", "text")]
        for this, position, role, text in zip(*columns, strict=True):
            if position == -1:
                if digest is not None:
                    insert()
                    convs.append(conv)
                    hashes.append(digest.hexdigest())
                conv, audit, at, state, digest, some = this, text, 0, START, hashlib.sha256(), False
                continue
            insert()
            edit, at = audit[at], at + 1
            if edit == "R":
                state = NEXT[state]
                put(ROLES[RAISED[state]], text)
            elif edit == "K":
                state = SYSTEM if state == START and role[:1] == "s" else NEXT[state]
                put(role, text)
        yield pa.RecordBatch.from_arrays([pa.array(convs, kind), pa.array(hashes, pa.string())], ["conv", "hash"])
    if digest is not None:
        insert()
        yield pa.RecordBatch.from_arrays(
            [pa.array([conv], kind), pa.array([digest.hexdigest()], pa.string())], ["conv", "hash"]
        )


def _or_space(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(" "))


def damage(rows: DataFrame) -> DataFrame:
    """Rows (conv, turn, role, text) with the faults of a test: by crc32 of ``conv:turn`` modulo 20,
    0 drops a row, 1 empties its text, 2 removes its end marks, 3 repeats it, 4 makes it a user's."""
    key = F.concat(_or_space(F.col("conv")), F.lit(":"), _or_space(F.col("turn")))
    kind = F.pmod(F.crc32(key.cast("binary")), F.lit(20))
    text = (
        F.when(F.col("kind") == 1, "")
        .when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
    )
    times = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return (
        rows.withColumn("kind", kind)
        .where("kind <> 0")
        .withColumns({"text": text, "role": F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))})
        .withColumn("time", F.explode(times))
        .drop("kind", "time")
    )


def _marked(rows: DataFrame, part_rows: int) -> DataFrame:
    """Rows with their position, the row before and the letter of their role and first fault."""
    placed = stored(place_rows(rows, ["conv"], ["turn"], {"role": "before"}, part_rows))
    said = F.sha2(F.concat(F.length("role"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"), 256)
    said = placed.withColumn("said", said)
    # Only what is said more than once in a conversation; counted before it is shuffled.
    repeated = said.groupBy("conv", "said").agg(F.min(POSITION).alias("first"), F.count("*").alias("n"))
    repeated = checkpointed(repeated.where("n > 1").drop("n"))
    found = lookup(said, repeated, ["conv", "said"], "left")
    bare = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r"))
    blank = F.length(bare) == 0
    duplicate = F.coalesce(F.col(POSITION) > F.col("first"), F.lit(False))
    fault = (
        F.when(blank, "blank")
        .when(duplicate, "duplicate")
        .when(~F.substring(bare, -1, 1).isin(".", "!", "?"), "truncated")
    )
    initial = F.substring("role", 1, 1)
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    letter = (
        F.when(F.col("fault").isin("blank", "duplicate"), GONE)
        .when(F.col("fault") == "truncated", F.upper(letter))
        .otherwise(letter)
    )
    pair = F.concat(F.substring("before", 1, 1), initial)
    return found.withColumn("fault", fault).withColumns(
        {"letter": letter, "illegal": F.col("before").isNotNull() & ~pair.isin("su", "ua", "au")}
    )


def repair_conversations(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    test_faults: bool = False,
    part_rows: int = 100_000,
) -> DataFrame:
    """One row per conversation: its faults, the cheapest repair and the hash of what it gives.

    A row's first fault counts: blank, duplicate (role and text seen before) or truncated (without
    an end mark). Edits: Keep (0), Relabel as user or assistant (1), Delete (2, the only one for
    blank and duplicate rows), Insert an empty user or assistant row (5); a truncated row that stays
    adds 5. The repaired roles are ``(s?(ua)+)?``. ``audit`` has the initials of the edits, of equal
    costs the least text. ``test_faults`` damages rows first, see ``damage``.

    Null roles and texts are one space: such a text is blank, such a role neither of the three.
    Rows are taken by turn, null turns first, rows of one turn by role and text. A null id is a
    conversation like any other. A conversation without rows (left by the damage) has zeros, an
    empty audit and the hash of the empty text; an empty table gives no rows. Other columns are
    not read. Positions, faults and signatures of a long conversation are worked out in parts; its
    hash is of one sequence of bytes, which one task reads row by row.
    """
    source = conversations.select(
        col(conv_col).alias("conv"),
        col(turn_col).cast("long").alias("turn"),
        _or_space(col(role_col)).alias("role"),
        _or_space(col(text_col)).alias("text"),
    )
    rows = damage(source) if test_faults else source
    marked = _marked(rows, part_rows)
    texts = marked.groupBy("conv", PART).agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct(POSITION, "letter"))), lambda x: x["letter"]), ""
        ).alias("letters")
    )
    signed = texts.groupBy("conv").agg(
        F.reverse(
            F.array_join(
                F.transform(F.array_sort(F.collect_list(F.struct(PART, "letters"))), lambda x: x["letters"]), ""
            )
        ).alias("reversed")
    )
    signed = stored(signed)
    distinct = signed.select("reversed").distinct()
    ordered = distinct.repartitionByRange("reversed").sortWithinPartitions("reversed")
    edits = stored(ordered.mapInArrow(repairs, "reversed string, cost long, audit string"))
    audits = stored(lookup(signed, edits, ["reversed"], "left").drop("reversed"))

    def counted(condition: Column) -> Column:
        return F.sum(condition.cast("long"))

    faults = marked.groupBy("conv").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"),
        *[counted(F.coalesce(F.col("fault") == f, F.lit(False))).alias(f) for f in ("blank", "duplicate", "truncated")],
        counted(F.col("illegal")).alias("illegal"),
    )
    heads = audits.select(
        "conv", F.lit(-1).cast("long").alias("at"), F.lit("").alias("role"), F.col("audit").alias("text")
    )
    lines = marked.select("conv", F.col(POSITION).alias("at"), "role", "text").union(heads)
    lines = lines.repartition("conv").sortWithinPartitions("conv", "at")
    kind = conversations.schema[conv_col].dataType
    arrow = to_arrow_type(kind)
    hashes = lines.mapInArrow(lambda b: repaired_hashes(b, arrow), f"conv {kind.simpleString()}, hash string")
    every = source.select("conv").distinct()
    joined = (
        every.unionByName(faults, allowMissingColumns=True)
        .unionByName(audits, allowMissingColumns=True)
        .unionByName(hashes, allowMissingColumns=True)
    )
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return joined.groupBy("conv").agg(
        *[F.coalesce(F.max(n), F.lit(0)).cast("long").alias(n) for n in numbers],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("hash"), F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    ).withColumnRenamed("conv", conv_col)
