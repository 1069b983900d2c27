"""Words, Arrow batches and shared settings of the text operators."""

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablebind.functions.names import col

#: Rows handed to Python at once. Spark's default of 10,000 whole texts is too many.
BATCH_ROWS = 256
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"

#: Bytes of UTF-8 that belong to an alphanumeric word, in lower case; others become blanks.
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SPACE = " \t\n\x0b\f\r"


def alphanumeric_words(text: bytes) -> list[bytes]:
    """The runs of letters, digits and non-ASCII characters, with A-Z in lower case."""
    return text.translate(WORD_BYTES).split()


def lower_words(text: bytes) -> list[bytes]:
    """The runs between ASCII white space, with A-Z in lower case."""
    return text.lower().split()


def texts(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A text column as UTF-8; null is empty."""
    return [x or b"" for x in batch.column(name).cast(pa.binary()).to_pylist()]


#: What a Python worker keeps from task to task: one operator's look-up tables at a time.
WORKER_MEMORY: dict[str, object] = {}


def worker_memory(owner: str, make: Callable[[], object]):
    """The tables of ``owner`` in this worker process, made when first asked for."""
    if owner not in WORKER_MEMORY:
        WORKER_MEMORY[owner] = make()
    return WORKER_MEMORY[owner]


def map_batches(
    df: DataFrame,
    fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str,
    owner: str = "",
) -> DataFrame:
    """``df`` through ``fn`` in Arrow batches of at most BATCH_ROWS rows. What the worker has kept
    for operators other than ``owner`` is let go first."""
    conf = df.sparkSession.conf
    if int(conf.get(BATCH_SETTING)) > BATCH_ROWS:
        conf.set(BATCH_SETTING, BATCH_ROWS)

    def run(batches):
        for name in [k for k in WORKER_MEMORY if k != owner]:
            del WORKER_MEMORY[name]
        return fn(batches)

    return df.mapInArrow(run, schema)


def id_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator reads, as ``id`` (long) and ``text``."""
    return df.select(col(id_col).cast("long").alias("id"), col(text_col).cast("string").alias("text"))


def remainder(id_col: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id is the empty text."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))
