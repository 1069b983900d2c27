"""Merge the several rows of one record."""

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tablebind.functions.missing import is_missing, is_numeric
from tablebind.functions.names import as_names, col
from tablebind.plans.ordered import GROUP_ROWS, PART, SIZE, by_group_size, place_by_runs

# Marks of a qualitative finding, names that always concatenate, names that
# never do, the share of text that makes a column concatenate, the separator.
QUALITATIVE = "[拒弃阴阳<>+-]"
SUMMARY_NAMES = "总结|小结?"
SINGLE_NAMES = (
    "name|gender|sex|company|姓名|单位|部门|性别|"
    "department|证$|号$|度$|联系|中心$|类型$|provider|"
    "^尿|度$|级^|量$|数$|值$"
)
TEXT_SHARE = 0.5
SEPARATOR = ";"

# Where a qualitative mark can be at all: a range is tested faster than single ideographs.
MAY_BE_QUALITATIVE = "[<>+一-鿿-]"


def _is_text(value: Column) -> Column:
    """Whether a value is text without a qualitative mark; null for a missing value."""
    is_qualitative = value.rlike(MAY_BE_QUALITATIVE) & value.rlike(QUALITATIVE)
    return F.when(~is_missing(value), ~is_numeric(value) & ~is_qualitative)


def detect_bind_modes(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: does merging concatenate it (``bind_all``) or keep one value?

    A column concatenates when at least half of its values are text, or its name says
    summary and it has a value, unless its name is on the list of single values.

    Columns settled by name or type (numbers, dates and logical values are no text) are
    not read. The values of the others become rows (column, value), so that the test is
    compiled once however wide the table is, and are counted before the one shuffle.
    """
    columns = df.columns if columns is None else list(columns)
    single = {c for c in columns if re.search(SINGLE_NAMES, c.lower())}
    summary = {c for c in columns if re.search(SUMMARY_NAMES, c.lower())} - single
    text = {c for c in columns if isinstance(df.schema[c].dataType, StringType)} - single
    tested = [c for c in columns if c in summary | text]
    places = {c: i for i, c in enumerate(tested)}
    names = df.sparkSession.createDataFrame(
        [(c, places.get(c, -1), c in summary) for c in columns],
        "column string, place int, is_summary boolean",
    )
    if not tested:
        return names.select("column", F.lit(False).alias("bind_all"))
    values = F.array(*[col(c).cast("string") for c in tested])
    counts = (
        df.select(F.posexplode(values).alias("place", "value"))
        .select("place", _is_text(F.col("value")).alias("is_text"))
        .groupBy("place")
        .agg(F.count_if("is_text").alias("texts"), F.count("is_text").alias("values"))
    )
    share = F.try_divide("texts", "values")
    mode = F.when(F.col("is_summary"), F.col("values") > 0).otherwise(share >= TEXT_SHARE)
    return names.join(counts, "place", "left").select(
        "column", F.coalesce(mode, F.lit(False)).alias("bind_all")
    )


def _first(name: str, df: DataFrame, order_by: Sequence[str]) -> Column:
    """Aggregate: the first non-missing value; a lone row keeps its value as it is."""
    missing = is_missing(col(name), df.schema[name].dataType)
    ranked = F.struct(
        missing.alias("missing"), *[col(o) for o in order_by], col(name).alias("_tb_value")
    )
    best = F.min(ranked)
    empty = best["missing"] & (F.count(F.lit(1)) > 1)
    return F.when(~empty, best["_tb_value"]).alias(name)


def _rows(names: Sequence[str], order_by: Sequence[str]) -> Column:
    """Aggregate: the group's values in row order."""
    values = [col(c).cast("string").alias(f"_tb_v{i}") for i, c in enumerate(names)]
    return F.sort_array(F.collect_list(F.struct(*[col(o) for o in order_by], *values)))


def _joined(rows: Column, index: int, is_lone: Column) -> Column:
    values = F.transform(rows, lambda r: r[f"_tb_v{index}"])
    kept = F.filter(values, lambda v: ~is_missing(v))
    several = F.when(F.size(kept) > 0, F.array_join(kept, SEPARATOR))
    return F.when(is_lone, values[0]).otherwise(several)


def bind_rows(
    df: DataFrame,
    ids: str | Sequence[str],
    order_by: str | Sequence[str],
    modes: Mapping[str, bool] | None = None,
    part_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Merge the rows that share ``ids`` into one record, in ``order_by`` order.

    A column whose mode is true concatenates its non-missing values with ``;`` and turns
    to text; any other column keeps its first non-missing value and its type. Rows with a
    missing id are left out. Without ``modes`` they are profiled first, in one extra job.
    Ordering columns are in the result only when ``modes`` names them.

    ``PART`` is 0 for every record of up to ``part_rows`` rows (a kilobyte of text counts
    as a row). The concatenation of a larger record continues in parts 1, 2, ... of
    ``part_rows`` rows each, fewer where texts are long. They hold no other columns:
    joining the parts by ``;`` gives the whole text, and no task holds more than a part. A row
    longer than a part leaves numbers out; a part without any value is null.
    """
    ids, order_by = as_names(ids), as_names(order_by)
    if modes is None:
        given = [c for c in df.columns if c not in ids and c not in order_by]
        modes = {r["column"]: r["bind_all"] for r in detect_bind_modes(df, given).collect()}
    values = [c for c in df.columns if c in modes and c not in ids]
    texts = [c for c in values if modes[c]]
    singles = [c for c in values if not modes[c]]

    used = list(dict.fromkeys([*ids, *order_by, *values]))
    has_id = reduce(lambda a, b: a & b, (col(i).isNotNull() for i in ids))
    records = df.where(has_id).select(*used)
    firsts = [_first(c, records, order_by) for c in singles]
    output = [*ids, PART, *values]
    if not texts:
        merged = records.groupBy(*ids).agg(F.lit(0).cast("long").alias(PART), *firsts)
        return merged.select(*output)

    def collected(rows: DataFrame, keys: Sequence[str], *more: Column) -> DataFrame:
        return rows.groupBy(*keys).agg(_rows(texts, order_by).alias("_tb_rows"), *more)

    def texts_of(grouped: DataFrame, is_lone: Column) -> DataFrame:
        joined = [_joined(F.col("_tb_rows"), i, is_lone).alias(c) for i, c in enumerate(texts)]
        kept = [c for c in grouped.columns if c != "_tb_rows"]
        return grouped.select(*kept, *joined)

    def usual(rows: DataFrame) -> DataFrame:
        grouped = collected(rows, ids, F.lit(0).cast("long").alias(PART), *firsts)
        return texts_of(grouped, F.size("_tb_rows") == 1).select(*output)

    def oversized(rows: DataFrame, count: int) -> DataFrame:
        # Ties are ordered by the texts, as in _rows.
        values = {c: col(c).cast("string") for c in texts if c not in order_by}
        placed = place_by_runs(
            rows.withColumns(values), ids, order_by, {}, count, part_rows, texts, list(values)
        )
        lone = (F.max(SIZE) == 1).alias("_tb_lone")
        cut = texts_of(collected(placed, [*ids, PART], lone), F.col("_tb_lone")).drop("_tb_lone")
        # The single values combine before their shuffle, and join on (ids, PART), where
        # no key is frequent.
        single = rows.groupBy(*ids).agg(F.lit(0).cast("long").alias(PART), *firsts)
        return cut.join(single, [*ids, PART], "left").select(*output)

    return by_group_size(records, ids, part_rows, usual, oversized, texts)
