"""Rewriting many files of one format in another."""

import uuid
from collections import Counter
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablebind.functions.names import balanced
from tablebind.sources.tables import (
    CSV_OPTIONS,
    FILE,
    SHEET,
    count_rows,
    list_sheets,
    sheet_groups,
    write_table,
)

#: The record of what has been written, in a folder of the target that readers skip.
DONE = "_converted"
#: Schemas written side by side.
WRITERS = 4

Names = Iterable[tuple[str, str]]


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def _record(spark: SparkSession, dst: str, sheets: Names) -> None:
    """Note sheets as written. Each call writes a folder of its own, so calls don't meet."""
    table = spark.createDataFrame(sorted(sheets), f"{FILE} string, {SHEET} string")
    table.coalesce(1).write.json(f"{dst.rstrip('/')}/{DONE}/{uuid.uuid4().hex}")


def _recorded(spark: SparkSession, dst: str) -> set[tuple[str, str]]:
    folder = f"{dst.rstrip('/')}/{DONE}"
    if not _exists(spark, folder):
        return set()
    # What a job that failed has left there is hidden from readers.
    lines = spark.read.option("recursiveFileLookup", True).schema(f"{FILE} string, {SHEET} string").json(folder)
    return {tuple(r) for r in lines.distinct().collect()}


def _among(sheets: Names) -> Column:
    files: dict[str, list[str]] = {}
    for file, sheet in sheets:
        files.setdefault(sheet, []).append(file)
    each = [(F.col(SHEET) == sheet) & F.col(FILE).isin(held) for sheet, held in files.items()]
    return balanced(each, lambda a, b: a | b) if each else F.lit(False)


def _publish(table: DataFrame, dst: str, fmt: str, mode: str) -> None:
    """Write the folders of the sheets of ``table``: they appear together when the job is done, and
    (by overwriting) in place of what an earlier call has left there."""
    write_table(table, dst, fmt, mode, [FILE, SHEET], partitionOverwriteMode="dynamic")


def convert_files(
    spark: SparkSession,
    src: str | Sequence[str],
    dst: str,
    from_fmt: str,
    to_fmt: str,
    workbooks: bool = False,
    resume: bool = False,
    **options: object,
) -> DataFrame:
    """Write each table found under ``src`` to ``dst/FILE=<file>/SHEET=<sheet>``.

    Files of equal names are told apart by their folders.

    The files of one schema are written by one job, whose folders appear when it is done and are
    recorded then. A call that failed is taken up with ``resume``: it writes what is not
    recorded, over what the failure may have left. Without ``resume`` the target must not exist.

    Returns the manifest: rows per file and sheet in the source (``Input``) and in the
    files written (``Output``). Every file keeps its own columns. Sources stay as they
    are. No shuffle but for CSV files of several blocks: each task writes what it has read.
    """
    if not resume and _exists(spark, dst):
        raise FileExistsError(f"{dst} exists; resume=True goes on with a conversion")
    found = list_sheets(spark, src, from_fmt, workbooks=workbooks, **options)
    done = _recorded(spark, dst) if resume else set()
    left = [e for e in found.entries if e[1:] not in done]
    groups = sheet_groups(replace(found, entries=left)) if left else []
    times = Counter(sheet for _, held in groups for sheet in held)
    shared = {sheet for sheet, n in times.items() if n > 1}

    def write(group: tuple[DataFrame, set[tuple[str, str]]]) -> None:
        table, held = group
        _publish(table, dst, to_fmt, "overwrite")
        _record(spark, dst, held)

    # Sheets that lie in files of several schemas are added to, and recorded when all are there.
    alone = [g for g in groups if not g[1] & shared]
    with ThreadPoolExecutor(WRITERS) as pool:
        list(pool.map(write, alone))
    begun: set[tuple[str, str]] = set()
    for table, held in (g for g in groups if g[1] & shared):
        fresh = held - begun
        if fresh:
            _publish(table.where(_among(fresh)), dst, to_fmt, "overwrite")
        if held - fresh:
            _publish(table.where(_among(held - fresh)), dst, to_fmt, "append")
        begun |= held
    if begun:
        _record(spark, dst, begun)

    # Counting needs no column but the folder names, which are kept as text.
    reader = spark.read.schema(f"{FILE} string, {SHEET} string").format(to_fmt)
    if to_fmt == "csv":
        reader = reader.options(**CSV_OPTIONS, enforceSchema=True)
    target = count_rows(reader.load(dst), "Output")
    if len(left) < len(found.entries):
        groups = sheet_groups(found)
    tagged = [table.select(FILE, SHEET) for table, _ in groups]
    source = count_rows(reduce(DataFrame.unionByName, tagged), "Input")
    return (
        found.as_table()
        .distinct()
        .join(source, [FILE, SHEET], "left")
        .join(target, [FILE, SHEET], "left")
        .select(
            FILE,
            SHEET,
            F.coalesce("Input", F.lit(0)).alias("Input"),
            F.coalesce("Output", F.lit(0)).alias("Output"),
        )
    )
