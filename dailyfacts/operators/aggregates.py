"""Distinct rows, counts and profiles.

All of these aggregate inside each task before they shuffle, so that a key or a
group of copies holding a large share of the rows reaches the shuffle as one row
per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows in a task that dedupes and writes: up to 0.8 KB a row, twice, of a task's memory.
ROWS = 300_000


def distinct_rows(df: DataFrame, *columns: str) -> DataFrame:
    """``GROUP BY`` all the columns without an aggregate."""
    return df.select(*columns).distinct()


def grouped_count(df: DataFrame, keys: list[str], column: str, name: str = "num") -> DataFrame:
    """Non-null values of ``column`` per group; a group of nulls only has 0."""
    return df.groupBy(*keys).agg(F.count(column).alias(name))


def count_where(df: DataFrame, predicate: Column, name: str = "n") -> DataFrame:
    """One row with the number of matching rows, 0 when there are none.

    The predicate is a filter rather than a conditional count so that it reaches the
    scan: row groups whose statistics rule it out are not read.
    """
    return df.where(predicate).agg(F.count(F.lit(1)).alias(name))


def dedupe(df: DataFrame) -> DataFrame:
    """Each distinct full row once; nulls equal each other."""
    return df.dropDuplicates()


def _tasks(sizes: list[tuple], most: int) -> tuple[list[tuple], int]:
    """``(group, its first task, its number of tasks)``, and how many tasks there are.

    Groups of more than ``most`` rows have several tasks; smaller ones share one in their order.
    """
    dealt, tasks, free = [], 0, 0
    for group, n in sizes:
        if n > free:
            parts = -(-n // most)
            dealt.append((group, tasks, parts))
            tasks, free = tasks + parts, most - n if parts == 1 else 0
        else:
            dealt.append((group, tasks - 1, 1))
            free -= n
    return dealt, max(tasks, 1)


def dedupe_in_groups(df: DataFrame, group: Column, sizes: DataFrame, most: int = ROWS, tasks: int = 50_000) -> DataFrame:
    """Each distinct full row once, in tasks that hold one ``group`` or a part of it, or several small ones.

    For a write by group, which then needs no shuffle of its own. ``sizes`` are few rows ``group, n``:
    every integer group, null included, and how many rows it has. A large group is dealt to tasks of
    about ``most`` rows by a hash of the whole row. Nothing is aggregated before the shuffle: copies
    of one row end in one task, which holds it once.
    """
    found = sorted(map(tuple, sizes.collect()), key=lambda x: (x[0] is None, x[0]))
    dealt, n = _tasks(found, max(most, sum(size for _, size in found) // tasks + 1))
    spark, names = df.sparkSession, [F.col(f"`{name}`") for name in df.columns]
    of_group = F.broadcast(spark.createDataFrame(dealt, "_group int, _first int, _parts int"))
    task = F.col("_first") + F.pmod(F.hash(*names), F.col("_parts"))
    placed = df.join(of_group, group.eqNullSafe(F.col("_group")), "left").select(
        *names, F.coalesce(task, F.lit(0)).alias("_task")
    )
    # The task is a column of the rows, so that the dedupe finds equal rows together.
    return placed.repartitionById(n, F.col("_task")).dropDuplicates().drop("_task")


def non_null_counts(df: DataFrame) -> DataFrame:
    """One row: the non-null count of every column."""
    return df.agg(*[F.count(F.col(f"`{name}`")).alias(name) for name in df.columns])


def null_counts(df: DataFrame) -> DataFrame:
    """One row: the null count of every column."""
    return df.agg(*[F.count_if(F.col(f"`{name}`").isNull()).alias(name) for name in df.columns])


def null_profile(df: DataFrame) -> DataFrame:
    """``column, non_null, nulls`` for every column, from one pass over the data."""
    total = F.count(F.lit(1)).alias("_rows")
    counts = df.agg(total, *[F.count(F.col(f"`{n}`")).alias(f"_{i}") for i, n in enumerate(df.columns)])
    lines = [
        F.struct(
            F.lit(name).alias("column"),
            F.col(f"_{i}").alias("non_null"),
            (F.col("_rows") - F.col(f"_{i}")).alias("nulls"),
        )
        for i, name in enumerate(df.columns)
    ]
    return counts.select(F.inline(F.array(*lines)))


def first_rows(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first ``n`` rows; with an order it is a top-n, without one any ``n`` rows."""
    return (df.orderBy(*order) if order else df).limit(n)


def repeated_keys(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Keys that carry more than one distinct row, with the number of those rows."""
    variants = distinct_rows(df, *dict.fromkeys([*keys, *columns]))
    return variants.groupBy(*keys).agg(F.count(F.lit(1)).alias("variants")).where("variants > 1")
