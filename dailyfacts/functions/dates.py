"""Dates from text, and the parts of a date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_day(value: Column, pattern: str = "d/M/yyyy") -> Column:
    """Day-first text to date, null when it is no such date.

    The default pattern takes days and months of one or two digits. Years have four
    digits; text with another year is no date.
    """
    day = F.try_to_date(value, pattern)
    return F.when(F.year(day).between(1, 9999), day)


def year_of(day: Column) -> Column:
    return F.year(day)


def month_of(day: Column) -> Column:
    return F.month(day)
