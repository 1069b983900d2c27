"""Tables in files: many files in, one file set out.

A file holds one sheet, or a folder is a workbook whose files are its sheets. Each row
keeps the names of its file and sheet in ``FILE`` and ``SHEET``. Where two files (or
workbooks) have the same name, ``FILE`` is the path below the folder they all share.
"""

import posixpath
import re
import warnings
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tablebind.functions.names import balanced, col
from tablebind.plans.checkpoints import checkpointed
from tablebind.plans.joins import lookup
from tablebind.sources.records import csv_records

FILE = "FILE"
SHEET = "SHEET"

# The sheet name of a file that is one sheet, and the file endings.
ONLY_SHEET = "Sheet1"
ENDINGS = {
    "csv": r"(?i)\.csv(\.gz|\.bz2|\.zst)?$",
    "json": r"(?i)\.jsonl?(\.gz|\.bz2|\.zst)?$",
    "parquet": r"(?i)\.parquet$",
    "orc": r"(?i)\.orc$",
}

# Compressed files are one block.
PACKED = r"(?i)\.(gz|bz2|zst)$"

# Quotes inside CSV fields are doubled and line breaks stand as they are, the way spreadsheets
# write them. Spark reads such a file in one task; see read_sheets for files of several blocks.
CSV_OPTIONS = {"header": True, "escape": '"', "multiLine": True}
# Written values keep their blanks.
CSV_AS_IS = {"nullValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}

SCHEMA_THREADS = 16

# CSV files up to which each header is read by a job of its own; the headers of more files are
# taken in one job. Options that do not change where the header is.
HEADER_JOBS = 64
PLAIN_OPTIONS = {"sep", "delimiter", "multiline", "quote", "nullvalue"}

# Options that records put together from lines understand, and the size of the blocks of a file.
RECORD_OPTIONS = PLAIN_OPTIONS | {"split", "header", "escape"}
BLOCK_CONF = "spark.sql.files.maxPartitionBytes"

# Sheets that are picked by a filter on their names rather than by a join.
FILTER_SHEETS = 1000


@dataclass(frozen=True)
class Sheets:
    """The sheets found under some paths: (path, file, sheet) each."""

    spark: SparkSession
    fmt: str
    workbooks: bool
    entries: list[tuple[str, str, str]]
    options: dict = field(default_factory=dict)
    #: The folder that names start below, where file names alone are not enough.
    root: str | None = None
    #: Bytes of the largest file that can be read in blocks.
    largest: int = 0

    def as_table(self) -> DataFrame:
        rows = [(name, sheet) for _, name, sheet in self.entries]
        return self.spark.createDataFrame(rows, f"{FILE} string, {SHEET} string")


def _one_form(path: str) -> str:
    """The path with one slash after its scheme, however it was written."""
    return re.sub("^([A-Za-z][A-Za-z0-9+.-]*):/+", r"\1:/", path)


def _names(
    path: Column, fmt: str, workbooks: bool, root: str | None = None
) -> tuple[Column, Column, Column]:
    """Path, file name and sheet name of a table, from the path of a data file.

    A folder with the format's ending, as Spark writes it, counts as one file. File names
    are paths below ``root`` if there is one.
    """
    pieces = F.split(path, "/")
    is_part = F.element_at(pieces, -2).rlike(ENDINGS[fmt])
    inner = F.when(is_part, F.regexp_replace(path, "/[^/]*$", "")).otherwise(path)
    pieces = F.split(inner, "/")
    leaf = F.element_at(pieces, -1)
    book = F.regexp_replace(inner, "/[^/]*$", "") if workbooks else inner
    if root is None:
        name = F.element_at(pieces, -2 if workbooks else -1)
    else:
        one_form = F.regexp_replace(book, "^([A-Za-z][A-Za-z0-9+.-]*):/+", "$1:/")
        name = F.substr(one_form, F.lit(len(root) + 2 if root else 1))
    if not workbooks:
        return inner, name, F.lit(ONLY_SHEET)
    return inner, name, F.regexp_replace(leaf, ENDINGS[fmt], "")


def _root(entries: Sequence[tuple[str, str, str]], workbooks: bool) -> str | None:
    """The folder to name files from if two of them have the same name."""
    books: dict[str, set[str]] = {}
    for path, name, _ in entries:
        path = _one_form(path)
        books.setdefault(name, set()).add(posixpath.dirname(path) if workbooks else path)
    if all(len(held) == 1 for held in books.values()):
        return None
    return posixpath.commonpath([posixpath.dirname(b) for held in books.values() for b in held])


def _listing(spark: SparkSession, paths: Sequence[str]) -> DataFrame | None:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    try:
        # Only paths and sizes are selected, so no file is opened for its content.
        return reader.load(list(paths)).select("path", "length")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    existing = []
    for path in paths:
        try:
            existing.append(reader.load(path).select("path", "length"))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    if len(existing) < len(paths):
        warnings.warn(f"{len(paths) - len(existing)} paths do not exist", stacklevel=3)
    if not existing:
        return None
    listing = existing[0]
    for more in existing[1:]:
        listing = listing.union(more)
    return listing


def list_sheets(
    spark: SparkSession,
    paths: str | Sequence[str],
    fmt: str,
    sheet: int | str | Sequence[int | str] | None = None,
    workbooks: bool = False,
    **options: object,
) -> Sheets:
    """Find the tables of format ``fmt`` below ``paths`` (files, folders or globs).

    ``sheet`` picks sheets by name or by position in their workbook, from 1; None takes
    all. Names that no workbook has are warned about.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    listing = _listing(spark, paths) if paths else None
    entries: list[tuple[str, str, str]] = []
    root, largest = None, 0
    if listing is not None:
        found = listing.where(F.col("path").rlike(ENDINGS[fmt]))
        packed = F.col("path").rlike(PACKED)

        def listed(root: str | None) -> list[tuple]:
            names = [n.alias(f"n{k}") for k, n in enumerate(_names(F.col("path"), fmt, workbooks, root))]
            sizes = found.groupBy(*names).agg(F.max(F.when(packed, 0).otherwise(F.col("length"))))
            return [tuple(r) for r in sizes.collect()]

        rows = listed(None)
        root = _root([r[:3] for r in rows], workbooks)
        if root is not None:
            rows = listed(root)
        entries = [r[:3] for r in rows]
        largest = max((r[3] for r in rows), default=0)
    if not entries:
        raise FileNotFoundError(f"no {fmt} file among the given paths")
    entries.sort(key=lambda e: (e[1], e[2], e[0]))
    if sheet is not None:
        picks = _picks(sheet)
        unknown = {p for p in picks if isinstance(p, str)} - {e[2] for e in entries}
        if unknown:
            warnings.warn(f"no such sheets: {', '.join(sorted(unknown))}", stacklevel=2)
        order: dict[str, list[str]] = {}
        for _, name, title in entries:
            titles = order.setdefault(name, [])
            if title not in titles:
                titles.append(title)
        entries = [
            e for e in entries if e[2] in picks or order[e[1]].index(e[2]) + 1 in picks
        ]
        if not entries:
            raise FileNotFoundError("no file has the wanted sheets")
    return Sheets(spark, fmt, workbooks, entries, dict(options), root, largest)


def _picks(sheet: int | str | Sequence[int | str]) -> list[int | str]:
    return [sheet] if isinstance(sheet, (int, str)) else list(sheet)


def _load(sheets: Sheets, paths: Sequence[str], schema: StructType | None = None) -> DataFrame:
    reader = sheets.spark.read.format(sheets.fmt)
    if sheets.fmt == "csv":
        reader = reader.options(**CSV_OPTIONS)
    elif sheets.fmt == "json":
        reader = reader.option("primitivesAsString", True)
    reader = reader.options(**{k: v for k, v in sheets.options.items() if k != "split"})
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(list(paths))


def read_sheets(sheets: Sheets, same_schema: bool = False) -> list[DataFrame]:
    """One DataFrame per distinct schema among the sheets; see ``sheet_groups``."""
    return [table for table, _ in sheet_groups(sheets, same_schema)]


def sheet_groups(sheets: Sheets, same_schema: bool = False) -> list[tuple[DataFrame, set[tuple[str, str]]]]:
    """One DataFrame per distinct schema among the sheets, and the (file, sheet) it holds.

    Spark applies one schema to all files of a read (CSV by position), so files are
    grouped by header or footer first: a small read per file that stops at its first
    line, or for many CSV files one job over their lines. ``same_schema`` skips that for
    file sets known to be uniform; CSV headers are then checked during the scan, and the
    columns of parquet and orc files are put together (a type that differs is an error).
    JSON is read by name and needs no grouping.

    CSV files of more than one block (``spark.sql.files.maxPartitionBytes``) are read by as many
    tasks, line breaks in cells or not, with one shuffle of their lines; see ``csv_records`` for
    what their quotes must be like. The option ``split`` asks for that, or with False against it.
    """
    paths = list(dict.fromkeys(e[0] for e in sheets.entries))
    held = {(name, sheet) for _, name, sheet in sheets.entries}
    schema = sheets.options.get("schema")
    if schema is not None:
        options = {k: v for k, v in sheets.options.items() if k != "schema"}
        plain = replace(sheets, options=options)
        return [(_tagged(plain, _load(plain, paths, schema)), held)]
    if sheets.fmt == "json":
        return [(_tagged(sheets, _load(sheets, paths)), held)]
    if same_schema and sheets.fmt != "csv":
        merged = replace(sheets, options={"mergeSchema": True, **sheets.options})
        return [(_tagged(merged, _load(merged, paths)), held)]
    if same_schema:
        first = _load(sheets, paths[:1]).schema
        reader = replace(sheets, options={"enforceSchema": False, **sheets.options})
        return [(_tagged(reader, _load(reader, paths, first)), held)]

    def schema_of(path: str) -> StructType:
        found = _load(sheets, [path]).schema
        if sheets.fmt != "csv":
            return found
        return StructType([StructField(f.name, StringType()) for f in found.fields])

    alike = [[path] for path in paths]
    if sheets.fmt == "csv" and len(paths) > HEADER_JOBS:
        if {o.lower() for o in sheets.options} <= PLAIN_OPTIONS:
            alike = _same_headers(sheets, paths)
    groups: dict[str, tuple[StructType, list[str]]] = {}
    with ThreadPoolExecutor(SCHEMA_THREADS) as pool:
        for some, found in zip(alike, pool.map(lambda some: schema_of(some[0]), alike)):
            groups.setdefault(found.json(), (found, []))[1].extend(some)
    at, blocks = _held(sheets), _in_blocks(sheets)
    return [
        (
            _from_records(sheets, group, found) if blocks else _tagged(sheets, _load(sheets, group, found)),
            set().union(*[at[path] for path in group]),
        )
        for found, group in groups.values()
    ]


def merged_groups(
    sheets: Sheets, name: Callable[[str], str] = str.upper
) -> list[tuple[DataFrame, set[tuple[str, str]]]]:
    """The sheets in as few DataFrames as their columns allow; columns a file lacks are null.

    The schemas of parquet and orc files are put together by Spark, in one distributed job for all
    files. Only where a column has several types, or two columns of different files would have the
    same ``name``, the files are halved; the parts that agree are put together again. Other
    formats are read as by ``sheet_groups``.
    """
    if sheets.fmt not in ("parquet", "orc") or sheets.options:
        return sheet_groups(sheets)
    reader = replace(sheets, options={"mergeSchema": True})

    def merged(paths: list[str]) -> list[tuple[StructType, list[str]]]:
        try:
            schema = _load(reader, paths).schema
            if len(paths) == 1 or len({name(f) for f in schema.names}) == len(schema):
                return [(schema, paths)]
        except (PySparkException, Py4JJavaError) as error:
            if len(paths) == 1 or "MERGE" not in str(error).upper():
                raise
        half = len(paths) // 2
        return merged(paths[:half]) + merged(paths[half:])

    def agrees(fields: dict[str, StructField], field: StructField) -> bool:
        known = fields.get(name(field.name), field)
        return (known.name, known.dataType) == (field.name, field.dataType)

    groups: list[tuple[dict[str, StructField], list[str]]] = []
    for schema, paths in merged(sorted({e[0] for e in sheets.entries})):
        fields = {name(f.name): f for f in schema.fields}
        whole = len(fields) == len(schema)
        for known, held in groups if whole else []:
            if all(agrees(known, f) for f in schema.fields):
                held.extend(paths)
                known.update({k: f for k, f in fields.items() if k not in known})
                break
        else:
            groups.append((fields if whole else {f.name: f for f in schema.fields}, list(paths)))
    at = _held(sheets)
    return [
        (
            _tagged(sheets, _load(sheets, held, StructType(list(fields.values())))),
            set().union(*[at[path] for path in held]),
        )
        for fields, held in groups
    ]


def _held(sheets: Sheets) -> dict[str, set[tuple[str, str]]]:
    """The (file, sheet) at each path."""
    at: dict[str, set[tuple[str, str]]] = {}
    for path, file, sheet in sheets.entries:
        at.setdefault(path, set()).add((file, sheet))
    return at


def _in_blocks(sheets: Sheets) -> bool:
    """Whether CSV files are to be read by records put together from lines."""
    options = {k.lower(): v for k, v in sheets.options.items()}
    if sheets.fmt != "csv" or "split" in options:
        return sheets.fmt == "csv" and bool(options["split"])
    if not options.keys() <= RECORD_OPTIONS or not options.get("header", True):
        return False
    if str(options.get("multiline", True)).lower() == "false":
        return False
    return sheets.largest > _bytes(sheets.spark.conf.get(BLOCK_CONF))


def _bytes(size: str) -> int:
    """A setting such as 134217728b, 128m or 1GB as a number."""
    number, unit = re.fullmatch(r"(\d+)\s*([a-z]*)", size.strip().lower()).groups()
    return int(number) << {"k": 10, "m": 20, "g": 30, "t": 40, "p": 50}.get(unit[:1], 0)


def _from_records(sheets: Sheets, paths: Sequence[str], schema: StructType) -> DataFrame:
    """The cells of CSV files out of their records."""
    options = {k: v for k, v in {**CSV_OPTIONS, **sheets.options}.items() if k.lower() not in ("split", "header")}
    records = csv_records(sheets.spark, paths, str(sheets.options.get("quote", '"'))).where("NOT first")
    shape = StructType([StructField(f"c{k}", StringType()) for k in range(len(schema))])
    parsed = F.from_csv("value", shape.simpleString(), {k: str(v) for k, v in options.items()})
    _, name, sheet = _names(_decoded(F.col("path")), sheets.fmt, sheets.workbooks, sheets.root)
    cells = records.select(name.alias(FILE), sheet.alias(SHEET), parsed.alias("cells"))
    return cells.select(FILE, SHEET, *[F.col(f"cells.c{k}").alias(f.name) for k, f in enumerate(schema.fields)])


def _same_headers(sheets: Sheets, paths: Sequence[str]) -> list[list[str]]:
    """CSV files by their first line that is not blank, read in one job.

    A file whose header goes on in the next line stands alone.
    """
    lines = sheets.spark.read.text(list(paths))
    path = _data_path()
    inner = _names(path, sheets.fmt, sheets.workbooks)[0]
    at = F.struct(path, F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    firsts = (
        lines.select(inner.alias("path"), at.alias("at"), "value")
        .where(F.trim("value") != "")
        .groupBy("path")
        .agg(F.min_by("value", "at").alias("line"))
    )
    known = {_one_form(r["path"]): r["line"] for r in firsts.collect()}
    groups: dict[str, list[str]] = {}
    quote = sheets.options.get("quote", '"')
    for path in paths:
        line = known.get(_one_form(path), "")
        alone = bool(quote) and line.count(quote) % 2 == 1
        groups.setdefault(f"{line}\n{path}" if alone else line, []).append(path)
    return list(groups.values())


def _decoded(path: Column) -> Column:
    # The path comes percent-encoded; a plus sign in it is itself.
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def _data_path() -> Column:
    return _decoded(F.col("_metadata.file_path"))


def _tagged(sheets: Sheets, df: DataFrame) -> DataFrame:
    _, name, sheet = _names(_data_path(), sheets.fmt, sheets.workbooks, sheets.root)
    columns = [col(c) for c in df.columns]
    return df.select(name.alias(FILE), sheet.alias(SHEET), *columns)


def read_tables(
    spark: SparkSession,
    paths: str | Sequence[str],
    fmt: str,
    sheet: int | str | Sequence[int | str] | None = None,
    workbooks: bool = False,
    same_schema: bool = False,
    **options: object,
) -> list[DataFrame]:
    """Read many files with ``FILE`` and ``SHEET``, one DataFrame per distinct schema.

    Paths that do not exist or are of another format are left out; none left is an error.
    ``options`` go to the Spark reader.
    """
    found = list_sheets(spark, paths, fmt, sheet, workbooks, **options)
    return read_sheets(found, same_schema)


def select_sheet(
    df: DataFrame, sheet: int | str | Sequence[int | str] | None, ordinal: str = SHEET
) -> DataFrame:
    """Rows of the wanted sheets, by name or by position in their file, from 1.

    ``ordinal`` is the column that orders the sheets of a file. Unknown names are warned
    about. Positions are found on the list of sheets, not on the rows.
    """
    if sheet is None:
        return df
    picks = _picks(sheet)
    names = [p for p in picks if isinstance(p, str)]
    positions = [p for p in picks if isinstance(p, int)]
    named = df.where(F.col(SHEET).isin(names)) if names else df.limit(0)
    if names:
        known = {r[0] for r in named.select(SHEET).distinct().collect()}
        unknown = sorted(set(names) - known)
        if unknown:
            warnings.warn(f"no such sheets: {', '.join(unknown)}", stacklevel=2)
    if not positions:
        return named
    place = F.dense_rank().over(Window.partitionBy(FILE).orderBy("_tb_ordinal", SHEET))
    chosen = (
        df.groupBy(FILE, SHEET)
        .agg(F.min(ordinal).alias("_tb_ordinal"))
        .withColumn("_tb_place", place)
        .where(F.col("_tb_place").isin(positions) | F.col(SHEET).isin(names))
        .select(FILE, SHEET)
    )
    few = chosen.head(FILTER_SHEETS + 1)
    if len(few) > FILTER_SHEETS:
        return lookup(df, checkpointed(chosen), [FILE, SHEET], "left_semi")
    # A filter on values reaches the scan and skips files, folders and stacked tables.
    files: dict[str | None, list[str | None]] = {}
    for row in few:
        files.setdefault(row[SHEET], []).append(row[FILE])
    if not files:
        return df.limit(0)
    wanted = [_same(SHEET, [title]) & _same(FILE, held) for title, held in files.items()]
    return df.where(balanced(wanted, lambda a, b: a | b))


def _same(name: str, values: Sequence[str | None]) -> Column:
    """The column has one of the values; null is a value like any other."""
    given = [v for v in values if v is not None]
    if len(given) == len(values):
        return F.col(name).isin(given)
    return F.col(name).isNull() | F.col(name).isin(given)


def count_rows(df: DataFrame, name: str) -> DataFrame:
    """Rows per file and sheet."""
    return df.groupBy(FILE, SHEET).agg(F.count(F.lit(1)).alias(name))


def write_table(
    df: DataFrame,
    path: str,
    fmt: str,
    mode: str = "errorifexists",
    partition_by: Sequence[str] = (),
    **options: object,
) -> None:
    """Write ``df`` as csv (with header, missing as empty), json, parquet or orc.

    In a csv of one column a missing value is written as a quoted empty one: readers skip
    blank lines.
    """
    if fmt == "csv":
        shown = [c for c in df.columns if c not in partition_by]
        if len(shown) == 1:
            value = F.coalesce(col(shown[0]).cast("string"), F.lit(""))
            df = df.select(*[value.alias(c) if c in shown else col(c) for c in df.columns])
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.options(**CSV_OPTIONS, **CSV_AS_IS)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.options(**options).save(path)


def read_written(spark: SparkSession, path: str, fmt: str, columns: Sequence[str]) -> DataFrame:
    """A table of texts that ``write_table`` has written."""
    reader = spark.read.schema(StructType([StructField(c, StringType()) for c in columns])).format(fmt)
    return (reader.options(**CSV_OPTIONS) if fmt == "csv" else reader).load(path)


def write_heads(heads: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write unmatched headings in order, as csv."""
    write_table(heads.orderBy(*heads.columns), path, "csv", mode)
