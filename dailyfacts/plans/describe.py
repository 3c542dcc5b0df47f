"""Flights with the descriptions of their codes."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from dailyfacts.operators.joins import as_keys, join_description
from dailyfacts.schemas import FLIGHTS, LOOKUPS, LOOKUPS_BY_FLIGHT_COLUMN
from dailyfacts.sources import read_table


def describe_flights(
    flights: DataFrame, lookups: Mapping[str, DataFrame], columns: Iterable[str]
) -> DataFrame:
    """Add ``<column>_description`` for each code column, null where the code is unknown.

    A lookup that several columns use is checked and measured once.
    """
    kinds, columns = dict(flights.dtypes), list(columns)
    used = {column: (LOOKUPS_BY_FLIGHT_COLUMN[column], kinds[column]) for column in columns}
    keyed = as_keys({f"{name} as {kind}": (lookups[name], kind) for name, kind in used.values()})
    for column in columns:
        name, kind = used[column]
        flights = join_description(flights, keyed[f"{name} as {kind}"], column)
    return flights


def describe_flights_of_tables(
    spark: SparkSession, columns: Iterable[str], database: str | None = None
) -> DataFrame:
    lookups = {name: read_table(spark, spec, database) for name, spec in LOOKUPS.items()}
    return describe_flights(read_table(spark, FLIGHTS, database), lookups, columns)
