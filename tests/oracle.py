"""Compare queries with their SQL, as multisets of rows."""

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _value(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> str | None:
    """None when both give the same columns and rows, else what differs."""
    relation = con.sql(sql)
    if sorted(df.columns) != sorted(relation.columns):
        return f"columns {sorted(df.columns)} / {sorted(relation.columns)}"
    ours = _rows(df.columns, df.collect())
    theirs = _rows(relation.columns, relation.fetchall())
    if ours == theirs:
        return None
    more, less = ours - theirs, theirs - ours
    return (
        f"{sum(ours.values())} / {sum(theirs.values())} rows; "
        f"only here: {str(list(more)[:1])[:600]}; only in SQL: {str(list(less)[:1])[:600]}"
    )
