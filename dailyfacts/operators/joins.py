"""Joins: fact to fact by day, fact to lookup by code.

No side is broadcast by hand unless its size is bounded or was measured. Otherwise the planner
and adaptive execution choose: a broadcast when the measured side is small, else a
sort-merge join whose oversized partitions (a day or code with a large share of the
rows) are split over several tasks.
"""

from __future__ import annotations

import operator
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# 64 MiB of values: well inside one executor's share of a broadcast.
BROADCAST_LIMIT = 64 * 1024 * 1024


def join_on_day(left: DataFrame, right: DataFrame, left_day: str, right_day: str) -> DataFrame:
    """Inner join on two date columns; both stay in the output, null days never match."""
    return left.join(right, F.col(left_day) == F.col(right_day), "inner")


def only_months_of(
    fact: DataFrame, year: str, month: str, days: DataFrame, day: str
) -> DataFrame:
    """Rows of ``fact`` in the months that ``days`` has at least one day of.

    Where ``fact`` is partitioned by the two columns the other months are not read at
    all. The months are the one thing broadcast without measuring: dates have years
    1 to 9999, so there are never more than 120,000 of them.
    """
    months = days.select(F.year(day).alias("_y"), F.month(day).alias("_m")).distinct()
    same = (fact[year] == months["_y"]) & (fact[month] == months["_m"])
    return fact.join(F.broadcast(months), same, "left_semi")


def _row_bytes(df: DataFrame) -> Column:
    widths = [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in df.columns]
    return reduce(operator.add, widths).cast("long") + 32


def value_bytes(df: DataFrame) -> int:
    """Size of all values as text plus a per-row allowance, from one aggregate."""
    return df.agg(F.coalesce(F.sum(_row_bytes(df)), F.lit(0))).first()[0]


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Mark ``df`` for broadcast when its measured size is within ``limit``."""
    return F.broadcast(df) if value_bytes(df) <= limit else df


class RepeatedCode(ValueError):
    """Two rows of a lookup have the same code, so that a join would repeat fact rows."""


def as_keys(
    lookups: Mapping[str, tuple[DataFrame, str]], limit: int = BROADCAST_LIMIT
) -> dict[str, DataFrame]:
    """``code, description`` of each lookup, with codes of the given type, each at most once.

    Codes are text; for an integer type they are cast, and rows whose codes are no integers
    or null go, as they match nothing. One pass over all lookups proves that codes are unique
    after the cast (``7`` and ``07`` are not) and measures them: the smallest ones are marked
    for broadcast as long as they are within ``limit`` together, the others are joined by shuffle.
    Where the lookup's part in each partition of the shuffle is within ``limit`` too, it is marked
    to be hashed there, so that the fact is not sorted; codes are unique, so the parts are even.
    """
    coded = {
        name: lookup.select(
            (F.col("code") if kind == "string" else F.col("code").try_cast(kind)).alias("code"), "description"
        ).where("code is not null")
        for name, (lookup, kind) in lookups.items()
    }
    if not coded:
        return {}
    tagged = [
        rows.select(F.lit(name).alias("lookup"), F.col("code").cast("string").alias("code"), _row_bytes(rows).alias("size"))
        for name, rows in coded.items()
    ]
    codes = reduce(DataFrame.union, tagged).groupBy("lookup", "code").agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("size")
    )
    found = codes.groupBy("lookup").agg(
        F.sum("size").alias("size"), F.min(F.when(F.col("n") > 1, F.col("code"))).alias("twice")
    ).collect()
    for row in sorted(found, key=lambda r: r["lookup"]):
        if row["twice"] is not None:
            raise RepeatedCode(f"lookup {row['lookup']} has several rows for code {row['twice']}")
    sizes = dict.fromkeys(coded, 0) | {row["lookup"]: row["size"] for row in found}
    left = limit
    for name in sorted(sizes, key=sizes.get):
        left -= sizes[name]
        if left >= 0:
            coded[name] = F.broadcast(coded[name])
        elif sizes[name] <= limit * int(coded[name].sparkSession.conf.get("spark.sql.shuffle.partitions")):
            coded[name] = coded[name].hint("shuffle_hash")
    return coded


def join_description(fact: DataFrame, keyed: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """Left join of a fact column to one of :func:`as_keys`; no fact row is repeated."""
    described = keyed.select(
        F.col("code").alias("_code"), F.col("description").alias(name or f"{column}_description")
    )
    return fact.join(described, fact[column] == described["_code"], "left").drop("_code")


def with_description(
    fact: DataFrame, lookup: DataFrame, column: str, *, name: str | None = None,
    limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Left join of a fact column to one ``code, description`` lookup, whose codes must be unique."""
    kind = fact.schema[column].dataType.typeName()
    kind = "int" if kind == "integer" else kind
    return join_description(fact, as_keys({column: (lookup, kind)}, limit)[column], column, name)
