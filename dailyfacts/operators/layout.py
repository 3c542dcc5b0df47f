"""Physical layout of rows before a write, and shared intermediate results."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cluster_for_write(df: DataFrame, *columns: str) -> DataFrame:
    """Bring equal values of ``columns`` together for a write.

    A rebalance instead of a plain hash repartition: values that hold a large share
    of the rows are split over several tasks, small ones are merged, and each task
    writes a file of about the advisory partition size.
    """
    return df.hint("rebalance", *columns)


def by_ranges(df: DataFrame, *keys: str) -> DataFrame:
    """Tasks that hold separate key ranges.

    A hash of the whole row breaks ties between equal keys; without it one key could
    not be spread over more than one task.
    """
    tie_break = F.xxhash64(*[F.col(f"`{name}`") for name in df.columns])
    return df.repartitionByRange(*[F.col(k) for k in keys], tie_break)


def range_layout(df: DataFrame, *keys: str) -> DataFrame:
    """Files that cover separate key ranges, sorted inside, so that scans can skip them."""
    return by_ranges(df, *keys).sortWithinPartitions(*keys)


def file_ranges(df: DataFrame, *columns: str) -> DataFrame:
    """``file, rows`` and ``low_<c>, high_<c>`` of each column, a row for each file of a scan."""
    ends = [f(F.col(c)).alias(f"{n}_{c}") for c in columns for n, f in (("low", F.min), ("high", F.max))]
    return df.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("rows"), *ends)


def without_files(df: DataFrame, ranges: DataFrame, column: str, low, high, most: int = 10_000) -> DataFrame:
    """``df`` without files in which no value of ``column`` is from ``low`` to ``high``.

    ``ranges`` says what files hold; files that it does not know are read. The names of ``most``
    files at most are put into the plan, those with the most rows; row groups of the others
    are skipped by their statistics. Excluded files are not opened.
    """
    outside = (F.col(f"high_{column}") < low) | (F.col(f"low_{column}") > high) | F.col(f"low_{column}").isNull()
    skipped = ranges.where(outside).orderBy(F.col("rows").desc(), "file").limit(most).select("file")
    names = [row["file"] for row in skipped.collect()]
    return df.where(~F.col("_metadata.file_path").isin(names)) if names else df


@contextmanager
def shared(df: DataFrame) -> Iterator[DataFrame]:
    """Persist ``df`` for two or more actions, and release it afterwards."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()
