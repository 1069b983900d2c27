"""Row order inside groups of any size.

Spark rows carry no order, so each operator whose result depends on it names ordering
columns. A window over the group is the plain way, but it sorts a whole group in one
task. Groups above a size bound are instead sorted by range over (keys, order): such a
group then lies in consecutive partitions, and each partition only needs to know what
the earlier ones held.

Rows that tie on the ordering columns are ordered by the values of the tie columns, so the
order is the same on every route. Rows that agree in all of them are interchangeable.
"""

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tablebind.functions.names import col
from tablebind.plans.checkpoints import checkpointed, stored
from tablebind.plans.joins import lookup

# Rows of one group that a single task may hold, and the bytes of text that count as a row.
GROUP_ROWS = 100_000
ROW_BYTES = 1024

# Rows a sorted partition should hold, and the most partitions a range sort may have: its
# boundaries are sampled on the driver.
RUN_ROWS = 1_000_000
MAX_RUNS = 20_000

# Characters of the first tie column that count for those boundaries; the samples stay short.
TIE_CHARS = 64

# Columns that place_rows adds: the piece of a group too large for one task, position in the
# group, both from 0, and the rows of the group.
PART = "PART"
POSITION = "_tb_position"
SIZE = "_tb_size"

# monotonically_increasing_id() keeps the partition number above the lower 33 bits.
ROW_BITS = 33

AT = "_tb_at"
RUN = "_tb_run"


@dataclass(frozen=True)
class BySize:
    """A table in two parts; either is None when it is known to be empty."""

    usual: DataFrame | None
    oversized: DataFrame | None
    oversized_rows: int = 0


def text_bytes(texts: Sequence[str]) -> Column:
    """The length of the given columns of a row as text."""
    lengths = (F.coalesce(F.octet_length(col(c).cast("string")), F.lit(0)) for c in texts)
    return reduce(lambda a, b: a + b, lengths, F.lit(0).cast("long"))


def weight(rows: Column, texts_bytes: Column) -> Column:
    """Rows, or as many rows as the text would fill."""
    return F.greatest(rows, F.floor(texts_bytes / ROW_BYTES).cast("long"))


def tie_columns(df: DataFrame, but: Sequence[str]) -> list[str]:
    """The columns that can be ordered, except ``but``."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return [
        name
        for name, kind in types.items()
        if name not in but and "map<" not in kind and "variant" not in kind
    ]


def split_by_size(
    df: DataFrame, keys: Sequence[str], limit: int, texts: Sequence[str] = ()
) -> BySize:
    """Part ``df`` into the groups of at most ``limit`` rows and the larger ones.

    Groups whose ``texts`` are long count for more than their rows. Runs one counting job
    that reads only the keys and those texts; without ``keys`` the whole table is one group.
    """
    rows = F.count(F.lit(1))
    size = weight(rows, F.sum(text_bytes(texts))) if texts else rows
    if not keys:
        total = df.agg(size.alias(SIZE)).first()[0] or 0
        return BySize(df, None) if total <= limit else BySize(None, df, total)
    large = df.groupBy(*map(col, keys)).agg(size.alias(SIZE)).where(F.col(SIZE) > limit)
    if large.isEmpty():
        return BySize(df, None)
    large = checkpointed(large)
    rows = large.agg(F.sum(SIZE)).first()[0]
    large = large.drop(SIZE)
    return BySize(
        lookup(df, large, keys, "left_anti"), lookup(df, large, keys, "left_semi"), rows
    )


def by_group_size(
    df: DataFrame,
    keys: Sequence[str],
    limit: int,
    usual: Callable[[DataFrame], DataFrame],
    oversized: Callable[[DataFrame, int], DataFrame],
    texts: Sequence[str] = (),
) -> DataFrame:
    """Apply ``usual`` to groups within the bound, ``oversized`` to the others and their rows."""
    parts = split_by_size(df, keys, limit, texts)
    if parts.oversized is None:
        return usual(parts.usual)
    if parts.usual is None:
        return oversized(parts.oversized, parts.oversized_rows)
    return usual(parts.usual).unionByName(oversized(parts.oversized, parts.oversized_rows))


def range_sorted(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    rows: int,
    ties: Sequence[str] = (),
) -> DataFrame:
    """``df`` with its global position in (keys, order, ties) and its run.

    A run is one sorted partition. The result is written out: range boundaries come from a
    sample, so position and run must not be computed twice. Rows that tie on the order are
    dealt by the first tie column.
    """
    default = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = min(max(default, -(-rows // RUN_ROWS)), MAX_RUNS)
    columns = list(map(col, [*keys, *order_by]))
    dealt = [
        F.substring(col(t), 1, TIE_CHARS) if df.schema[t].dataType == StringType() else col(t)
        for t in ties[:1]
    ]
    ordered = df.repartitionByRange(runs, *columns, *dealt)
    ordered = ordered.sortWithinPartitions(*columns, *map(col, ties))
    ordered = ordered.withColumn(AT, F.monotonically_increasing_id())
    return stored(ordered.withColumn(RUN, F.shiftright(AT, ROW_BITS)))


def place_by_window(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    previous: Mapping[str, str],
    ties: Sequence[str] = (),
) -> DataFrame:
    """As ``place_rows``, for groups that fit one task."""
    group = Window.partitionBy(*map(col, keys))
    order = group.orderBy(*map(col, [*order_by, *ties]))
    return df.withColumns(
        {
            PART: F.lit(0).cast("long"),
            POSITION: (F.row_number().over(order) - 1).cast("long"),
            SIZE: F.count(F.lit(1)).over(group),
            **{new: F.lag(col(c)).over(order) for c, new in previous.items()},
        }
    )


def place_by_runs(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    previous: Mapping[str, str],
    rows: int,
    limit: int,
    texts: Sequence[str] = (),
    ties: Sequence[str] = (),
) -> DataFrame:
    """As ``place_rows``, for groups of any size, of ``rows`` rows together."""
    ranged = range_sorted(df, keys, order_by, rows, ties)
    names = list(map(col, keys))
    # One row per group and run: at most one per group and partition.
    runs = ranged.groupBy(*names, RUN).agg(
        F.min(AT).alias("_tb_from"),
        F.count(F.lit(1)).alias("_tb_rows"),
        F.sum(text_bytes(texts)).alias("_tb_bytes"),
        *[F.max_by(col(c), AT).alias(f"_tb_last{i}") for i, c in enumerate(previous)],
    )
    group = Window.partitionBy(*names)
    order = group.orderBy(RUN)
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    lasts = [f"_tb_last{i}" for i in range(len(previous))]
    runs = runs.select(
        *names,
        RUN,
        "_tb_from",
        F.coalesce(F.sum("_tb_rows").over(earlier), F.lit(0)).alias("_tb_before"),
        F.sum("_tb_rows").over(group).alias(SIZE),
        F.coalesce(F.sum("_tb_bytes").over(earlier), F.lit(0)).alias("_tb_bytes"),
        *[F.lag(last).over(order).alias(last) for last in lasts],
    )
    inside = Window.partitionBy(*names, RUN).orderBy(AT)
    within = {n: F.lag(col(c)).over(inside) for c, n in previous.items()}
    if texts:
        above = inside.rowsBetween(Window.unboundedPreceding, -1)
        within["_tb_read"] = F.coalesce(F.sum(text_bytes(texts)).over(above), F.lit(0))
    if within:
        ranged = ranged.withColumns(within)
    placed = lookup(ranged, checkpointed(runs), [*keys, RUN], "inner")
    is_first = F.col(AT) == F.col("_tb_from")
    position = F.col(AT) - F.col("_tb_from") + F.col("_tb_before")
    # A piece begins at each multiple of the limit, counted in rows before or in their text.
    read = F.col("_tb_bytes") + (F.col("_tb_read") if texts else F.lit(0))
    piece = F.floor(weight(position, read) / limit)
    return placed.select(
        *map(col, df.columns),
        piece.cast("long").alias(PART),
        position.alias(POSITION),
        SIZE,
        *[
            F.when(is_first, F.col(last)).otherwise(F.col(new)).alias(new)
            for last, new in zip(lasts, previous.values())
        ],
    )


def place_rows(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    previous: Mapping[str, str] | None = None,
    limit: int = GROUP_ROWS,
    texts: Sequence[str] = (),
) -> DataFrame:
    """Add each row's ``POSITION`` in its group, from 0, and the ``SIZE`` of the group.

    ``PART`` cuts a group into consecutive pieces of at most ``limit`` rows, or fewer where
    ``texts`` are long; a row longer than a piece leaves numbers out. ``previous`` maps a column to the name under which its value in the
    previous row of the group is added. Ties are ordered by the other columns, as they stand.
    """
    previous = previous or {}
    ties = tie_columns(df, [*keys, *order_by])
    return by_group_size(
        df,
        keys,
        limit,
        lambda small: place_by_window(small, keys, order_by, previous, ties),
        lambda large, rows: place_by_runs(
            large, keys, order_by, previous, rows, limit, texts, ties
        ),
        texts,
    )
