"""Which of the top rows of a sheet is its header.

Sheets come as a cells table: ``FILE``, ``SHEET``, ``row``, ``col`` (both from 1),
``value``.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablebind.functions.missing import is_missing, is_numeric
from tablebind.plans.checkpoints import checkpointed
from tablebind.plans.joins import lookup
from tablebind.plans.ordered import PART
from tablebind.sources.tables import FILE, SHEET

# The rows examined, and the length a name stays below.
TOP_ROWS = 10
NAME_CHARS = 64

# Cells one list may hold: the widest sheet a spreadsheet file can have.
LIST_CELLS = 16_384

# Top cells of one sheet that a single task may count, and those dealt to one task.
SHEET_CELLS = 1_000_000
DEALT_CELLS = 500_000


def header_profile(cells: DataFrame, rows: int = TOP_ROWS, na_rm: bool = False) -> DataFrame:
    """How much each of the top rows looks like a header.

    ``Valid`` is the share of cells that could be names (not missing, no number, short),
    ``Unique`` that of distinct ones, ``Complete`` that of filled cells, each of the sheet
    width; with ``na_rm`` the first two are shares of the filled cells.

    Two passes. The first counts the cells of each sheet, which gives its width. The second reads
    the top rows only and deals them by sheet, uncombined: a table of all distinct cells before the
    shuffle saves next to nothing and spills. Sheets of more than ``SHEET_CELLS`` top cells are
    dealt by cell instead.
    """
    top = F.col("row") <= rows
    sheets = checkpointed(
        cells.groupBy(FILE, SHEET).agg(F.max("col").alias("width"), F.count_if(top).alias("size"))
    )
    total, widest = sheets.agg(F.sum("size"), F.max("size")).first()
    tasks = -(-(total or 0) // DEALT_CELLS) or 1
    shown = cells.where(top).select(FILE, SHEET, F.col("row").alias("RowNum"), "col", "value")
    if (widest or 0) <= SHEET_CELLS:
        return _profiled(shown, sheets, na_rm, tasks)
    wide = sheets.where(F.col("size") > SHEET_CELLS)
    names = wide.select(FILE, SHEET)
    usual = lookup(shown, names, [FILE, SHEET], "left_anti")
    usual = _profiled(usual, sheets.where(F.col("size") <= SHEET_CELLS), na_rm, tasks)
    oversized = lookup(shown, names, [FILE, SHEET], "left_semi")
    return usual.unionByName(_profiled(oversized, wide, na_rm, None))


def _profiled(shown: DataFrame, sheets: DataFrame, na_rm: bool, tasks: int | None) -> DataFrame:
    """The profile of the top cells of ``sheets``, dealt by sheet to ``tasks`` or as Spark does."""
    nulls = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in shown.schema.fields}
    # One row more for each sheet carries its width.
    ends = sheets.select(FILE, SHEET, nulls["RowNum"], F.col("width").alias("col"), nulls["value"])
    dealt = shown.union(ends)
    if tasks is not None:
        dealt = dealt.repartition(tasks, FILE, SHEET)
    value = F.col("value")
    filled = F.col("RowNum").isNotNull() & ~is_missing(value)
    is_name = filled & ~is_numeric(value) & (F.length(value) < NAME_CHARS)
    counts = dealt.groupBy(FILE, SHEET, "RowNum").agg(
        F.count_if(is_name).alias("names"),
        F.count_distinct(F.when(is_name, value)).alias("distinct_names"),
        F.count_if(filled).alias("filled"),
        F.max("col").alias("last"),
    )
    # At most one row more than the top rows for each sheet.
    width = F.max("last").over(Window.partitionBy(FILE, SHEET))
    base = F.col("filled" if na_rm else "width")
    return (
        counts.withColumn("width", width)
        .where(F.col("RowNum").isNotNull())
        .select(
            FILE,
            SHEET,
            "RowNum",
            F.try_divide("names", base).alias("Valid"),
            F.try_divide("distinct_names", base).alias("Unique"),
            F.try_divide("filled", "width").alias("Complete"),
        )
    )


def find_header_row(cells: DataFrame, rows: int = TOP_ROWS) -> DataFrame:
    """The top row of each sheet with the highest Valid, Unique, Complete, then the first.

    A minimum of a struct instead of a window: it combines before the shuffle.
    """
    best = F.min(
        F.struct(
            (-F.col("Valid")).alias("v"),
            (-F.col("Unique")).alias("u"),
            (-F.col("Complete")).alias("c"),
            F.col("RowNum").alias("r"),
        )
    )
    return (
        header_profile(cells, rows)
        .groupBy(FILE, SHEET)
        .agg(best.alias("best"))
        .select(
            FILE,
            SHEET,
            F.col("best.r").alias("RowNum"),
            (-F.col("best.v")).alias("Valid"),
            (-F.col("best.u")).alias("Unique"),
            (-F.col("best.c")).alias("Complete"),
        )
    )


def header_values(
    cells: DataFrame, rows: int = TOP_ROWS, list_cells: int = LIST_CELLS
) -> DataFrame:
    """The cells of each header row as a list in column order, null where a cell is missing.

    One list per sheet. A row of more than ``list_cells`` cells goes on in ``PART`` 1, 2, ...,
    so that a list is bounded whatever the cells table holds.
    """
    winner = find_header_row(cells, rows).select(FILE, SHEET, "RowNum")
    top = cells.where(F.col("row") <= rows).withColumnRenamed("row", "RowNum")
    value = F.when(~is_missing(F.col("value")), F.col("value"))
    part = F.floor((F.col("col") - 1) / list_cells).cast("long").alias(PART)
    listed = F.sort_array(F.collect_list(F.struct("col", value.alias("value"))))
    return (
        top.join(winner, [FILE, SHEET, "RowNum"])
        .groupBy(FILE, SHEET, "RowNum", part)
        .agg(listed.alias("cells"))
        .select(FILE, SHEET, "RowNum", PART, F.col("cells.value").alias("vars"))
    )
