"""Date-window predicates that reach the scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_days(df: DataFrame, column: str, first: str, last: str) -> Column:
    """True when ``date(column)`` lies in ``first..last``, both included.

    Written as a half-open range on the bare column, with literals of the
    column's own type, so that the parquet or JDBC reader can use it.
    """
    kind = df.schema[column].dataType
    start = F.lit(first).cast("date").cast(kind)
    stop = F.date_add(F.lit(last).cast("date"), 1).cast(kind)
    return (F.col(column) >= start) & (F.col(column) < stop)


def as_timestamp(text: Column) -> Column:
    """Timestamp from text; unreadable text and zero dates give NULL."""
    return F.try_to_timestamp(F.when(~text.startswith("0000-00-00"), text))
