"""Column functions. All are built-in expressions, independent of the ANSI setting."""

from dailyfacts.functions.casts import flag_to_bool, flag_to_int, lenient_int, rejected
from dailyfacts.functions.dates import month_of, parse_day, year_of

__all__ = [
    "flag_to_bool",
    "flag_to_int",
    "lenient_int",
    "month_of",
    "parse_day",
    "rejected",
    "year_of",
]
