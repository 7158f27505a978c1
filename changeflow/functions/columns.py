"""Derived columns. All of them are native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _seconds(column: str) -> Column:
    # The first cast does nothing to a zoned timestamp and lets a zone-less one be counted.
    return F.col(column).cast("timestamp").cast("long")


def elapsed_hours(start: str, end: str, digits: int = 1) -> Column:
    """Hours from ``start`` to ``end`` in whole seconds, rounded half up.

    NULL while ``end`` is open; negative when the two are out of order.
    """
    hours = (_seconds(end) - _seconds(start)) / 3600
    return F.when(F.col(end).isNotNull(), F.round(hours, digits))


def flag_equals(column: str, value: object) -> Column:
    """True or false by equality, NULL for a NULL input."""
    return F.col(column) == F.lit(value)


def day_bucket(column: str) -> Column:
    """Calendar day in the session time zone."""
    return F.to_date(column)


def count_where(condition: Column) -> Column:
    """How many rows meet the condition. A NULL condition does not count."""
    return F.count_if(condition)
