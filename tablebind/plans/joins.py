"""Joins against tables that are usually, but not provably, small."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablebind.functions.names import col

BROADCAST_BYTES = 32 * 1024 * 1024


def byte_size(df: DataFrame) -> int:
    """The size of the table written as text."""
    row = F.to_json(F.struct(*[col(c) for c in df.columns]))
    return df.agg(F.sum(F.octet_length(row).cast("long"))).first()[0] or 0


def lookup(df: DataFrame, small: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join ``df`` to ``small``, which has one row per key; a null key is a key like any other.

    ``small`` is measured first, so it should be checkpointed. Within the bound it is
    broadcast. Above, the join is left to Catalyst and adaptive execution, which shuffle
    both sides and split a skewed partition.
    """
    names = {k: f"_tb_key{i}" for i, k in enumerate(keys)}
    side = small.withColumnsRenamed(names)
    same = reduce(lambda a, b: a & b, (col(k).eqNullSafe(col(n)) for k, n in names.items()))
    if byte_size(small) <= BROADCAST_BYTES:
        side = F.broadcast(side)
    return df.join(side, same, how).drop(*names.values())
