"""Merge similar columns by a mapping dictionary."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablebind.functions.missing import trimmed
from tablebind.functions.names import col
from tablebind.operators.bind_rows import SEPARATOR
from tablebind.sources.dictionaries import MapRow, load_mapping
from tablebind.sources.tables import FILE, SHEET


def inconsistent_targets(mapping: DataFrame) -> DataFrame:
    """The targets (``InDb``) whose ``BindAll`` is neither all true nor all false; null is false."""
    target, every = F.upper("InDb"), F.coalesce("BindAll", F.lit(False))
    return (
        mapping.where(F.col("InDb").isNotNull())
        .groupBy(target.alias("InDb"))
        .agg(F.bool_and(every).alias("every"), F.bool_or(every).alias("some"))
        .where(F.col("every") != F.col("some"))
        .select("InDb")
    )


def prepare_mapping(mapping: DataFrame) -> list[MapRow]:
    """The checked dictionary: sorted, upper case, one bind mode per target."""
    rows = load_mapping(mapping)
    mixed = [r["InDb"] for r in inconsistent_targets(mapping).orderBy("InDb").collect()]
    if mixed:
        raise ValueError(f"BindAll is not consistent for: {', '.join(mixed)}")
    return rows


@dataclass(frozen=True)
class BoundColumns:
    data: DataFrame
    unmapped: DataFrame


def merged(sources: Sequence[Column], bind_all: bool) -> Column:
    """One text out of several columns: the first value, or all of them joined by ``;``."""
    values = [trimmed(s) for s in sources]
    if not bind_all:
        return F.coalesce(*values)
    # concat_ws leaves out nulls, which is what trimmed() makes of missing values.
    return F.nullif(F.concat_ws(SEPARATOR, *values), F.lit(""))


def bind_columns(df: DataFrame, mapping: DataFrame) -> BoundColumns:
    """Merge the columns of ``df`` that ``mapping`` sends to one target.

    ``mapping`` holds ``InFile`` (column here), ``InDb`` (target, null to drop the column)
    and ``BindAll`` (join all values, or keep the first). Names of the mapping are upper
    cased, so bring those of ``df`` to upper case first. Sources merge in table order.
    The output holds ``FILE`` and ``SHEET``, the targets in the order of their first
    source, then the other columns. ``unmapped`` lists the columns the mapping does not
    know by position and name; they are kept.

    The data is one projection: no shuffle and no job.
    """
    rows = prepare_mapping(mapping)
    names = df.columns
    dropped = {r.source for r in rows if r.target is None}
    modes = {r.target: r.bind_all for r in rows if r.target is not None}
    feeds = {t: {t} | {r.source for r in rows if r.target == t} for t in modes}
    sources = {t: [c for c in names if c in feed and c not in dropped] for t, feed in feeds.items()}
    targets_of = {
        c: [r.target for r in rows if r.source == c and r.target is not None] for c in names
    }
    used = {c for cs in sources.values() for c in cs}

    first = [t for c in names for t in targets_of[c] if sources[t]]
    rest = [c for c in names if not targets_of[c] and c not in dropped]
    output = list(dict.fromkeys([*[c for c in (FILE, SHEET) if c in names], *first, *rest]))
    clashes = [c for c in output if c.upper() in modes and c not in modes]
    if clashes:
        raise ValueError(f"columns differ from a target in case only: {', '.join(clashes)}")

    def column(name: str) -> Column:
        if name in modes:
            return merged([col(c) for c in sources[name]], modes[name]).alias(name)
        return col(name)

    data = df.select(*[column(c) for c in output if c in modes or c not in used])
    known = used | dropped | {FILE, SHEET} | {r.source for r in rows}
    unmapped = [(i, c) for i, c in enumerate(names, 1) if c not in known]
    report = df.sparkSession.createDataFrame(unmapped, "idx int, var string")
    return BoundColumns(data, report)
