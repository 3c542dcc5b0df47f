"""Projections and column-name operators."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def explode_records(documents: DataFrame, array: str = "records", name: str = "record") -> DataFrame:
    """One row per array element; null and empty arrays give no row."""
    return documents.select(F.explode(array).alias(name))


def lower_names(df: DataFrame) -> DataFrame:
    """All column names in lower case. Names that differ only in case are an error."""
    names = [name.lower() for name in df.columns]
    clashes = sorted(name for name, n in Counter(names).items() if n > 1)
    if clashes:
        raise ValueError(f"column names collide in lower case: {', '.join(clashes)}")
    return df.toDF(*names)


def add_month_partitions(df: DataFrame, year: str = "year", month: str = "month") -> DataFrame:
    """Copies of year and month to partition by, so that the originals stay in the files."""
    return df.withColumns({"_year": F.col(year), "_month": F.col(month)})
