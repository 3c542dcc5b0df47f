"""Casts that give null for bad input instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Blanks, a sign, digits with an optional decimal tail, blanks.
_NUMBER = r"^[\x00-\x20]*[+-]?([0-9]+\.?|\.)[0-9]*[\x00-\x20]*$"
# The decimal tail, with the digits before it.
_DECIMAL_TAIL = r"([0-9]*)\.[0-9]*"


def lenient_int(value: Column) -> Column:
    """Text to int: blanks trimmed, a decimal tail cut off, anything else null.

    ``"5.7"`` gives 5 and ``".5"`` gives 0, as a cast outside ANSI mode does;
    ``try_cast`` alone gives null for both. Text that is no number never reaches the
    cast, which would raise and catch an exception for each such value.
    """
    text = value.cast("string")
    whole = F.when(text.contains("."), F.regexp_replace(text, _DECIMAL_TAIL, "0$1")).otherwise(text)
    return F.when(text.rlike(_NUMBER), whole.try_cast("int"))


def flag_to_int(value: Column) -> Column:
    """Float to int towards zero; null for NaN and values out of range."""
    return value.try_cast("int")


def flag_to_bool(value: Column) -> Column:
    """Number to boolean: every value but zero is true, 0.5 included."""
    return value.cast("boolean")


def rejected(raw: Column, parsed: Column) -> Column:
    """True where a non-blank input was lost by a lenient cast."""
    return (F.trim(raw.cast("string")) != "") & parsed.isNull()
