"""Column references by exact name."""

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(name: str) -> Column:
    """The column of that name, whatever dots, spaces or quotes it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def as_names(names: str | Sequence[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def balanced(parts: Sequence, join: Callable):
    """``parts`` joined two by two, so that many of them don't nest deeply."""
    parts = list(parts)
    while len(parts) > 1:
        parts = [join(*parts[k : k + 2]) if k + 1 < len(parts) else parts[k] for k in range(0, len(parts), 2)]
    return parts[0]
