"""Calendar arithmetic that counts boundaries rather than elapsed time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def days_between(start: Column, end: Column) -> Column:
    """Midnights crossed."""
    return F.datediff(end, start)


def hours_between(start: Column, end: Column) -> Column:
    """Full hours crossed on the clock: 10:59 to 11:01 is one. Works on zone-less stamps in any session zone."""
    return F.datediff(end, start) * 24 + F.hour(end) - F.hour(start)


def weekday(day: Column) -> Column:
    """0 is Sunday."""
    return F.dayofweek(day) - 1


def is_weekend(day: Column) -> Column:
    return weekday(day).isin(0, 6)
