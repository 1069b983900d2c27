"""Configuration tables: column mappings and extraction rules.

Both are read to the driver, because their rows become column expressions: they are written
by hand, and a plan of that many expressions is the only bound.
"""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row


def config_rows(df: DataFrame, required: Sequence[str]) -> list[Row]:
    """The rows of a hand-written table, with the required columns in that order."""
    absent = [c for c in required if c not in df.columns]
    if absent:
        raise ValueError(f"the dictionary lacks: {', '.join(absent)}")
    return df.select(*required).collect()


@dataclass(frozen=True)
class MapRow:
    source: str
    target: str | None
    bind_all: bool


def load_mapping(df: DataFrame) -> list[MapRow]:
    """Mapping rows (``InFile``, ``InDb``, ``BindAll``) in upper case, sorted by target."""
    rows = [
        MapRow(r["InFile"].upper(), r["InDb"] and r["InDb"].upper(), bool(r["BindAll"]))
        for r in config_rows(df, ["InFile", "InDb", "BindAll"])
    ]
    return sorted(rows, key=lambda r: (r.target is None, r.target or "", r.source))


@dataclass(frozen=True)
class Rule:
    pattern: str
    extract: str
    field: str


def load_rules(df: DataFrame) -> list[Rule]:
    """Extraction rules (``Pattern``, ``Extract``, ``Fld``) in table order."""
    rows = config_rows(df, ["Pattern", "Extract", "Fld"])
    return [Rule(r["Pattern"], r["Extract"] or "", r["Fld"]) for r in rows]
