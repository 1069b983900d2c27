"""Report tables: blanked repeats, footers, HTML with a spanned head."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablebind.functions.names import as_names, col
from tablebind.plans.checkpoints import checkpointed
from tablebind.plans.joins import lookup
from tablebind.plans.ordered import GROUP_ROWS, PART, POSITION, SIZE, place_rows, tie_columns

# The marks of a heading, the alignments, the shown text of a missing cell.
LEFT_MARK = "="
UP_MARK = "|"
ALIGNMENTS = {"l": "left", "c": "center", "r": "right"}
MISSING_CELL = "NA"
BLANK_HEAD = "&nbsp;&nbsp;&nbsp;"

# Rows of a foot up to which Spark cuts groups to their last rows before the shuffle, if the
# session does not say otherwise; and equal rows made at once.
TOP_K = 1000
TOP_K_CONF = "spark.sql.optimizer.windowGroupLimitThreshold"
COPIES = 10_000


def blank_repeats(
    df: DataFrame,
    columns: str | Sequence[str],
    order_by: str | Sequence[str],
    partition_by: str | Sequence[str] = (),
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Replace a value equal to the one in the previous row by the empty text.

    The comparison is with the original previous value, as text; null equals nothing.
    Groups (or, without ``partition_by``, a table) above ``group_rows`` (a kilobyte of text
    counts as a row) are compared across sorted partitions rather than in one task.
    """
    columns, keys = as_names(columns), as_names(partition_by)
    previous = _previous_names(columns)
    placed = place_rows(df, keys, as_names(order_by), previous, group_rows, df.columns)
    return placed.select(
        *[_blanked(c, previous[c]).alias(c) if c in previous else col(c) for c in df.columns]
    )


def _previous_names(columns: Sequence[str]) -> dict[str, str]:
    return {c: f"_tb_previous{i}" for i, c in enumerate(columns)}


def _blanked(name: str, previous: str) -> Column:
    return F.when(col(name) == F.col(previous), "").otherwise(col(name).cast("string"))


@dataclass(frozen=True)
class BodyAndFoot:
    body: DataFrame
    foot: DataFrame


def split_footer(
    df: DataFrame,
    rows: int,
    order_by: str | Sequence[str],
    partition_by: str | Sequence[str] = (),
) -> BodyAndFoot:
    """Part the last ``rows`` rows, of the table or of each group, from the others.

    Ties on the order are ordered by the other columns, so a foot has exactly ``rows`` rows. A
    group that would be all foot is an error. Only the last rows of each group are ordered (a
    top-k, cut before the shuffle); the body is what lies before them. A foot too long for
    that is found by position instead, in groups of any size.
    """
    keys, order_by = as_names(partition_by), as_names(order_by)
    if rows <= 0:
        return BodyAndFoot(df, df.limit(0))
    if rows >= int(df.sparkSession.conf.get(TOP_K_CONF, str(TOP_K))):
        check_footer(df, rows, keys)
        placed = place_rows(df, keys, order_by, texts=df.columns)
        is_foot = F.col(POSITION) >= F.col(SIZE) - rows
        names = list(map(col, df.columns))
        return BodyAndFoot(placed.where(~is_foot).select(*names), placed.where(is_foot).select(*names))
    columns, ordered = df.columns, [*order_by, *tie_columns(df, [*keys, *order_by])]
    latest = [col(o).desc() for o in ordered]
    place = F.struct(*[col(o).alias(f"o{i}") for i, o in enumerate(ordered)])
    by, grouped = (keys, df) if keys else (["_tb_all"], df.withColumn("_tb_all", F.lit(0)))
    names = list(map(col, by))
    # One row more than the foot tells whether there is a body, and whether it begins with a row
    # equal to the first of the foot.
    rank = F.row_number().over(Window.partitionBy(*names).orderBy(*latest))
    cut = grouped if keys else grouped.orderBy(*latest).limit(rows + 1)
    last = checkpointed(cut.withColumn("_tb_rank", rank).where(F.col("_tb_rank") <= rows + 1))
    in_foot = F.col("_tb_rank") <= rows
    starts = checkpointed(
        last.groupBy(*names).agg(
            F.count(F.lit(1)).alias("_tb_count"),
            F.min(F.when(in_foot, place)).alias("_tb_start"),
            F.max(F.when(~in_foot, place)).alias("_tb_next"),
        )
    )
    short = starts.where(F.col("_tb_count") <= rows).select(*names).head(3)
    if not keys and (short or starts.isEmpty()):
        raise ValueError(f"the foot of {rows} rows would take the whole table")
    if short:
        groups = ", ".join(str(tuple(r)) for r in short)
        raise ValueError(f"the foot of {rows} rows would take whole groups, such as {groups}")
    body = lookup(grouped, starts, by, "inner").where(place < F.col("_tb_start")).select(*map(col, columns))
    tied = starts.where(F.col("_tb_next").eqNullSafe(F.col("_tb_start")))
    if not tied.isEmpty():
        # Only where equal rows lie on both sides are those counted, in a scan of their own.
        taken = lookup(last.where(in_foot), tied, by, "inner")
        taken = taken.where(place == F.col("_tb_start")).groupBy(*names).agg(
            F.count(F.lit(1)).alias("_tb_taken"), F.first("_tb_start").alias("_tb_start")
        )
        marked = lookup(grouped, checkpointed(taken), by, "inner")
        body = body.unionByName(_spare(marked, place, by, columns))
    return BodyAndFoot(body, last.where(in_foot).select(*map(col, columns)))


def _spare(marked: DataFrame, place: Column, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows equal to the first of the foot for which the foot has no more room."""
    spare = (
        marked.where(place == F.col("_tb_start"))
        .groupBy(*map(col, keys))
        .agg(
            F.first(F.struct(*map(col, columns))).alias("_tb_row"),
            (F.count(F.lit(1)) - F.first("_tb_taken")).alias("_tb_spare"),
        )
        .where("_tb_spare > 0")
        .select("_tb_row", "_tb_spare", F.expr(f"explode(sequence(0L, _tb_spare - 1, {COPIES}L))").alias("_tb_from"))
    )
    copies = F.expr(f"explode(array_repeat(0, int(least({COPIES}, _tb_spare - _tb_from))))")
    return spare.select("_tb_row", copies).select("_tb_row.*")


def check_footer(df: DataFrame, rows: int, keys: Sequence[str]) -> None:
    """Raise when some group has no more than ``rows`` rows."""
    if not keys:
        if len(df.select(F.lit(1)).head(rows + 1)) <= rows:
            raise ValueError(f"the foot of {rows} rows would take the whole table")
        return
    short = df.groupBy(*keys).count().where(F.col("count") <= rows).select(*keys).head(3)
    if short:
        names = ", ".join(str(tuple(r)) for r in short)
        raise ValueError(f"the foot of {rows} rows would take whole groups, such as {names}")


def resolve_alignment(align: str | Sequence[str] | None, width: int) -> list[str]:
    """One of left, center, right per column, read off the first letters.

    By default the first column is left, the others centred. A short list repeats its
    last entry, a long one is cut.
    """
    given = ["left", "center"] if align is None else as_names(align)
    try:
        full = [ALIGNMENTS[a[:1].lower()] for a in given]
    except KeyError as unknown:
        raise ValueError("align takes l(eft), c(enter) and r(ight) only") from unknown
    return (full + full[-1:] * width)[:width]


def resolve_heading(
    heading: Sequence[str | None] | Sequence[Sequence[str | None]], width: int
) -> list[list[str | None]]:
    """Heading rows in which every cell is text or a mark; an all-missing column is None.

    Missing cells extend what is left of them in the first row (``=``) and what is above
    them in the other rows (``|``).
    """
    one_row = all(cell is None or isinstance(cell, str) for cell in heading)
    rows = [list(heading)] if one_row else [list(row) for row in heading]
    if not rows or any(len(row) != width for row in rows):
        raise ValueError(f"the table has {width} columns, the heading has another number")
    blank = [all(row[c] is None for row in rows) for c in range(width)]
    marks = [LEFT_MARK] + [UP_MARK] * (len(rows) - 1)
    filled = [
        [mark if cell is None else cell for cell in row] for row, mark in zip(rows, marks)
    ]
    for c in range(width):
        if blank[c]:
            filled[0][c] = None
    return filled


def _run(cells: Sequence[str | None], mark: str) -> int:
    """1 and the number of leading cells that are ``mark``."""
    return 1 + next((i for i, cell in enumerate(cells) if cell != mark), len(cells))


def render_head(heading: Sequence[Sequence[str | None]], align: Sequence[str]) -> str:
    """``<thead>`` of a resolved heading."""

    def is_mark(cell: str | None) -> bool:
        return cell in (LEFT_MARK, UP_MARK)

    def cell_html(r: int, c: int) -> str:
        cell = heading[r][c]
        across = _run(heading[r][c + 1 :], LEFT_MARK)
        down = _run([row[c] for row in heading[r + 1 :]], UP_MARK)
        if across > 1 and down > 1:
            block = [heading[i][j] for i in range(r, r + down) for j in range(c, c + across)]
            if sum(not is_mark(b) for b in block) > 1:
                # Other heads lie below the span, so only the rows can be joined.
                across = 1
        side = "center" if _run(heading[r][c + 1 :], LEFT_MARK) > 1 else align[c]
        spans = (f'rowspan="{down}" ' if down > 1 else "") + (
            f'colspan="{across}" ' if across > 1 else ""
        )
        text = BLANK_HEAD if cell is None else f" {cell} "
        return f'   <th {spans}style="text-align:{side};">{text}</th>\n'

    rows = [
        "".join(cell_html(r, c) for c in range(len(row)) if not is_mark(row[c]))
        for r, row in enumerate(heading)
    ]
    return " <thead>\n" + "".join(f"  <tr>\n{row}  </tr>\n" for row in rows) + " </thead>\n"


def escaped(value: Column) -> Column:
    """Text with the characters that HTML reserves replaced."""
    # Fixed values; the ampersand goes first.
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        value = F.replace(value, F.lit(char), F.lit(entity))
    return value


def _row_html(cells: Sequence[Column], align: Sequence[str]) -> Column:
    pieces = []
    for cell, side in zip(cells, align):
        text = escaped(F.coalesce(cell, F.lit(MISSING_CELL)))
        pieces += [F.lit(f'   <td style="text-align:{side};"> '), text, F.lit(" </td>\n")]
    return F.concat(F.lit("  <tr>\n"), *pieces, F.lit("  </tr>\n"))


def html_tables(
    df: DataFrame,
    by: str | Sequence[str],
    order_by: str | Sequence[str],
    columns: Sequence[str] | None = None,
    heading: Sequence | None = None,
    foot_rows: int = 0,
    align: str | Sequence[str] | None = None,
    blank: str | Sequence[str] = (),
    caption: str | None = None,
    width: str = "100%",
    part_rows: int = GROUP_ROWS,
) -> DataFrame:
    """One HTML table per group of ``by``, its rows in ``order_by`` order.

    ``heading`` is one list of texts or a list of such rows: ``=`` joins a cell to the one
    on its left, ``|`` to the one above. ``blank`` names the columns whose repeats are
    blanked. The last ``foot_rows`` rows go to ``<tfoot>``.

    A table of more than ``part_rows`` rows (a kilobyte of text counts as a row) comes in
    several pieces, ``PART`` 0, 1, ...; put together in that order they are the table.
    """
    keys, order_by = as_names(by), as_names(order_by)
    columns = [c for c in df.columns if c not in keys] if columns is None else list(columns)
    align = resolve_alignment(align, len(columns))
    rows = resolve_heading(columns if heading is None else heading, len(columns))
    title = "" if caption is None else f"<caption>{caption}</caption>\n"
    opening = f"<table width={width}>\n{title}{render_head(rows, align)}<tbody>\n"
    to_foot = "</tbody>\n<tfoot>\n"
    closing = "</tfoot>\n</table>" if foot_rows else "</tbody>\n</table>"
    if foot_rows:
        check_footer(df, foot_rows, keys)

    if not keys and df.isEmpty():
        empty = [(0, opening + (to_foot if foot_rows else "") + closing)]
        return df.sparkSession.createDataFrame(empty, f"{PART} long, html string")
    previous = _previous_names(as_names(blank))
    shown = df.select(*[col(c) for c in dict.fromkeys([*keys, *order_by, *columns])])
    placed = place_rows(shown, keys, order_by, previous, part_rows, columns)
    cells = [
        _blanked(c, previous[c]) if c in previous else col(c).cast("string") for c in columns
    ]
    at, size = F.col(POSITION), F.col(SIZE)
    piece = F.concat(
        F.when(at == 0, opening).otherwise(""),
        F.when(at == size - foot_rows, to_foot).otherwise(""),
        _row_html(cells, align),
        F.when(at == size - 1, closing).otherwise(""),
    )
    names = [col(k) for k in keys]
    pieces = placed.select(*names, PART, at, piece.alias("_tb_html"))
    ordered = F.sort_array(F.collect_list(F.struct(POSITION, "_tb_html")))
    return (
        pieces.groupBy(*names, PART)
        .agg(ordered.alias("_tb_rows"))
        .select(*names, PART, F.array_join(F.col("_tb_rows._tb_html"), "").alias("html"))
    )
