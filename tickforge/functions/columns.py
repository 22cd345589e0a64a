"""Small helpers shared by the column functions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def array_flag(array, member: str) -> Column:
    """1 if the array holds ``member``, 0 if not, NULL for a NULL array."""
    return F.array_contains(as_column(array), member).cast("int")


def is_filled(text) -> Column:
    """Neither NULL nor the empty string; never NULL itself."""
    return F.coalesce(as_column(text), F.lit("")) != ""
