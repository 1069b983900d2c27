"""Stack many tables into one, with provenance and a reconciliation of rows."""

import re
from collections import Counter
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NullType, StringType, TimestampNTZType, TimestampType

from tablebind.functions.names import balanced, col
from tablebind.sources.tables import (
    FILE,
    SHEET,
    count_rows,
    list_sheets,
    merged_groups,
    read_written,
    write_table,
)

# What names lose, which names hold dates, the spreadsheet day zero, and the
# texts that are dates.
NAME_FILLERS = "[. ]"
DATE_NAMES = "(日期|时间)$"
SERIAL_ORIGIN = "1899-12-30"
SERIAL_DAY = r"^\d{5}$|^\d{5}\.\d+"
COMPACT_DAY = r"^\d{8}$"
WRITTEN_DAY = r"^\s*(\d{4})([-/])(\d{1,2})\2(\d{1,2})(?!\d)"

# Rows looked at before a column is suspected to hold nothing.
PROBE_ROWS = 200
PROBE_THREADS = 16

# Sheets whose rows are counted while they are read and written.
OBSERVED = 500


def plain_name(name: str) -> str:
    return re.sub(NAME_FILLERS, "", name).upper()


def normalize_names(df: DataFrame) -> DataFrame:
    """Upper-case names without dots and spaces; names that then coincide are an error."""
    names = list(map(plain_name, df.columns))
    repeated = [n for n, times in Counter(names).items() if times > 1]
    if repeated:
        raise ValueError(f"duplicated column names: {', '.join(repeated)}")
    return df.toDF(*names)


def _is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, StringType)


def _filled(df: DataFrame, name: str) -> Column:
    return F.nullif(col(name), F.lit("")) if _is_text(df, name) else col(name)


def empty_to_null(df: DataFrame) -> DataFrame:
    """Empty texts become null."""
    return df.select(*[_filled(df, c).alias(c) for c in df.columns])


def stringify(df: DataFrame) -> DataFrame:
    """Every column as text."""
    return df.select(*[col(c).cast("string").alias(c) for c in df.columns])


def filled_columns(df: DataFrame) -> list[str]:
    """The columns with at least one non-null value, in order.

    A look at the first rows settles most columns; one aggregate reads the others, and
    only those, in full.
    """
    seen: set[str] = set()
    columns = [c for c in df.columns if not isinstance(df.schema[c].dataType, NullType)]
    for row in df.select(*[col(c).isNotNull().alias(c) for c in columns]).head(PROBE_ROWS):
        seen.update(c for c in columns if row[c])
    open_columns = [c for c in columns if c not in seen]
    if open_columns:
        counts = df.agg(*[F.count(col(c)).alias(c) for c in open_columns]).first()
        seen.update(c for c in open_columns if counts[c])
    return [c for c in df.columns if c in seen]


def drop_all_null(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Remove the columns that are null in every row, but for those in ``keep``."""
    filled = set(filled_columns(df)) | set(keep)
    return df.select(*[col(c) for c in df.columns if c in filled])


def to_date(value: Column) -> Column:
    """A date from text: spreadsheet day number, yyyymmdd, or y-m-d / y/m/d with any time.

    Null when it is none of these.
    """
    day = F.floor(value.try_cast("double"))
    serial = F.date_add(F.lit(SERIAL_ORIGIN).cast("date"), day.cast("int"))
    compact = F.concat_ws("-", value.substr(1, 4), value.substr(5, 2), value.substr(7, 2))
    written = F.concat_ws("-", *[F.regexp_extract(value, WRITTEN_DAY, i) for i in (1, 3, 4)])
    return (
        F.when(value.rlike(SERIAL_DAY), serial)
        .when(value.rlike(COMPACT_DAY), compact.try_cast("date"))
        .when(value.rlike(WRITTEN_DAY), written.try_cast("date"))
    )


def coerce_dates(df: DataFrame, name_pattern: str = DATE_NAMES) -> DataFrame:
    """Columns whose name matches ``name_pattern`` become dates, value by value."""

    def coerced(name: str) -> Column:
        if not re.search(name_pattern, name):
            return col(name)
        dtype = df.schema[name].dataType
        if isinstance(dtype, (DateType, TimestampType, TimestampNTZType)):
            return col(name).cast("date").alias(name)
        return to_date(col(name).cast("string")).alias(name)

    return df.select(*[coerced(c) for c in df.columns])


def union_tables(tables: Sequence[DataFrame]) -> DataFrame:
    """Stack tables by column name as text; absent columns are null.

    Columns stand in order of first appearance. The cast comes first, since tables read
    apart may give one column several types.
    """
    names = list(dict.fromkeys(c for t in tables for c in t.columns))

    def widened(table: DataFrame) -> DataFrame:
        held = set(table.columns)
        absent = F.lit(None).cast("string")
        return table.select(*[(col(c) if c in held else absent).alias(c) for c in names])

    return balanced([widened(stringify(t)) for t in tables], DataFrame.union)


def bind_report(
    inputs: Sequence[DataFrame], output: DataFrame, sheets: DataFrame | None = None
) -> DataFrame:
    """Rows per file and sheet in the inputs and, beside them, in the output.

    ``sheets`` lists the sheets expected, so that empty ones are reported with 0 rows.
    """
    tagged = [normalize_names(t).select(FILE, SHEET) for t in inputs]
    found = count_rows(reduce(DataFrame.unionByName, tagged), "Input")
    if sheets is not None:
        found = (
            sheets.select(FILE, SHEET)
            .distinct()
            .join(found, [FILE, SHEET], "full")
            .select(FILE, SHEET, F.coalesce("Input", F.lit(0)).alias("Input"))
        )
    return found.join(count_rows(output, "Output"), [FILE, SHEET], "left")


@dataclass(frozen=True)
class BoundTables:
    data: DataFrame
    report: DataFrame


def _filled_in_any(tables: Sequence[DataFrame]) -> set[str]:
    """The columns with a value in some table; the small jobs of the tables run side by side."""
    with ThreadPoolExecutor(PROBE_THREADS) as pool:
        return {FILE, SHEET}.union(*pool.map(filled_columns, tables))


def _bound(tables: Sequence[DataFrame], filled: set[str] | None, date_names: str) -> DataFrame:
    bound = union_tables([empty_to_null(normalize_names(t)) for t in tables])
    if filled is not None:
        bound = bound.select(*[col(c) for c in bound.columns if c in filled])
    return stringify(coerce_dates(bound, date_names))


def bind_tables(
    tables: Sequence[DataFrame],
    sheets: DataFrame | None = None,
    compress: bool = True,
    date_names: str = DATE_NAMES,
) -> BoundTables:
    """Stack tables that carry ``FILE`` and ``SHEET`` into one table of text.

    Names are normalised, empty texts become null, columns without any value are removed
    (``compress``), date columns are coerced. ``report`` reconciles the rows.
    """
    filled = _filled_in_any([empty_to_null(normalize_names(t)) for t in tables]) if compress else None
    data = _bound(tables, filled, date_names)
    return BoundTables(data, bind_report(tables, data, sheets))


def bind_files(
    spark: SparkSession,
    paths: str | Sequence[str],
    fmt: str,
    sheet: int | str | Sequence[int | str] | None = 1,
    compress: bool = True,
    date_names: str = DATE_NAMES,
    target: str | None = None,
    to_fmt: str = "parquet",
    **options: object,
) -> BoundTables:
    """Read many files and bind them; see ``read_tables`` and ``bind_tables``.

    With a ``target`` the data is written there and ``data`` reads it. The rows of each sheet are
    counted on their way, as they are read and as they are written, so the report needs no scan of
    its own; of more than OBSERVED sheets it is counted afterwards.
    """
    found = list_sheets(spark, paths, fmt, sheet, **options)
    groups = merged_groups(found, plain_name)
    tables = [table for table, _ in groups]
    if target is None:
        return bind_tables(tables, found.as_table(), compress, date_names)
    filled = _filled_in_any([empty_to_null(normalize_names(t)) for t in tables]) if compress else None
    sheets = sorted({e[1:] for e in found.entries})
    if len(sheets) > OBSERVED:
        data = _bound(tables, filled, date_names)
        write_table(data, target, to_fmt)
        written = read_written(spark, target, to_fmt, data.columns)
        return BoundTables(written, bind_report(tables, written, found.as_table()))
    place = {s: k for k, s in enumerate(sheets)}
    read = [Observation() for _ in groups]
    seen = [t.observe(o, *_counts(held, place)) for o, (t, held) in zip(read, groups)]
    wrote = Observation()
    data = _bound(seen, filled, date_names)
    write_table(data.observe(wrote, *_counts(sheets, place)), target, to_fmt)
    rows_in: Counter = Counter()
    for observed in read:
        rows_in.update({k: n or 0 for k, n in observed.get.items()})
    rows_out = wrote.get
    rows = [(*s, rows_in[f"s{k}"], rows_out.get(f"s{k}") or None) for s, k in place.items()]
    report = spark.createDataFrame(rows, f"{FILE} string, {SHEET} string, Input long, Output long")
    return BoundTables(read_written(spark, target, to_fmt, data.columns), report)


def _counts(sheets: Iterable[tuple[str, str]], place: dict[tuple[str, str], int]) -> list[Column]:
    """The rows of each sheet, named by its number."""
    return [
        F.count_if((F.col(FILE) == file) & (F.col(SHEET) == sheet)).alias(f"s{place[file, sheet]}")
        for file, sheet in sheets
    ]


def table_dims(df: DataFrame | Sequence[DataFrame]) -> DataFrame:
    """Rows and columns of each sheet of a cells table, or of tables as read.

    Those carry ``FILE`` and ``SHEET``, which do not count; a table without rows has no sheet
    to report.
    """
    if not isinstance(df, DataFrame):
        sized = [
            t.select(FILE, SHEET, F.lit(len(set(t.columns) - {FILE, SHEET})).alias("columns"))
            for t in df
        ]
        return (
            balanced(sized, DataFrame.union)
            .groupBy(FILE, SHEET)
            .agg(F.count(F.lit(1)).alias("rows"), F.max("columns").cast("long").alias("columns"))
        )
    return df.groupBy(FILE, SHEET).agg(
        F.max("row").cast("long").alias("rows"), F.max("col").cast("long").alias("columns")
    )
