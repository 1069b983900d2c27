"""Token counts with a shortcut for words that are one token."""

import pyarrow as pa
from pyspark.sql import DataFrame

from tablebind.llm.common import id_text, map_batches, texts
from tablebind.llm.tokenizer import count_runs, counts_owner, whole_tokens


def token_counts(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit.

    The driver proves once which vocabulary strings encode alone as one token; that set, bounded
    by the vocabulary, is broadcast. A task counts such pre-tokens directly and merges the rest.

    Null and empty texts have 0 bytes and 0 tokens. Repeated rows each give a row, a null id
    stays null, an empty table gives none. Other columns are not read.
    """
    proven = docs.sparkSession.sparkContext.broadcast(whole_tokens(path))

    def count(batches):
        runs = count_runs(path, proven.value)
        for batch in batches:
            data = texts(batch, "text")
            tokens = [sum(map(runs.__getitem__, x.split())) for x in data]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(map(len, data), pa.int64()),
                    pa.array(tokens, pa.int64()),
                    pa.array([n > limit for n in tokens], pa.bool_()),
                ],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return map_batches(
        id_text(docs, id_col, text_col),
        count,
        "doc_id long, n_bytes long, n_tokens long, over_limit boolean",
        counts_owner(path),
    )
