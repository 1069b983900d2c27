"""What counts as a missing value, and what counts as a number."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

# Fixed values.
NA_TEXT = "NA"
BLANKS = " \t\r\n"
NUMERIC = (
    r"^\s*[+-]?(?:"
    r"(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"
    r"|0[xX][0-9a-fA-F]+"
    r"|(?i:inf|infinity)"
    r")\s*$"
)


def is_missing(value: Column, dtype: DataType | None = None) -> Column:
    """Null, the empty string or exactly ``NA``; never null itself.

    ``dtype`` spares columns that cannot hold text the two string comparisons.
    """
    if dtype is not None and not isinstance(dtype, StringType):
        return value.isNull()
    return value.isNull() | value.isin("", NA_TEXT)


def is_numeric(value: Column) -> Column:
    """True for text that reads as a number; ``NaN`` does not."""
    return value.rlike(NUMERIC)


def trimmed(value: Column) -> Column:
    """Text without outer blanks; null when nothing or ``NA`` is left."""
    text = F.trim(value.cast("string"), F.lit(BLANKS))
    return F.when(~is_missing(text), text)
