"""Predicates and filters."""

from __future__ import annotations

import operator
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def any_of(predicates: Iterable[Column]) -> Column:
    """True when one of the predicates is; false for none at all."""
    return reduce(operator.or_, predicates, F.lit(False))


def any_null(columns: Iterable[str]) -> Column:
    """True when at least one column is null; a row with several nulls counts once."""
    return any_of(F.col(name).isNull() for name in columns)


def rows_with_null(df: DataFrame, *columns: str) -> DataFrame:
    return df.where(any_null(columns))
