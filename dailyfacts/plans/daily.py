"""Daily cases of one country next to the departures of every origin."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dailyfacts.operators.aggregates import distinct_rows, grouped_count
from dailyfacts.operators.columns import add_month_partitions
from dailyfacts.operators.joins import join_on_day, only_months_of
from dailyfacts.operators.writes import write_by_month
from dailyfacts.schemas import CASES, FLIGHTS, TableSpec
from dailyfacts.sources import read_model, read_table
from dailyfacts.sources.tables import qualified

COUNTRY = "United_States_of_America"
COLUMNS = ["daterep", "country", "cases", "deaths", "origin", "fl_date", "num"]


# Stored sides of the daily question, bucketed by the day that they are joined on.
DEPARTURES = TableSpec("departures_by_day", (("origin", "string"), ("fl_date", "date"), ("num", "bigint")))
CASE_DAYS = TableSpec(
    "cases_by_day", tuple((name, kind) for name, kind in CASES.columns if name in ("daterep", "country", "cases", "deaths"))
)


def country_days(cases: DataFrame, country: str) -> DataFrame:
    """Distinct ``daterep, country, cases, deaths`` of one country.

    A day reported twice with different counts stays twice.
    """
    return distinct_rows(
        cases.where(F.col("country") == country), "daterep", "country", "cases", "deaths"
    )


def departures(flights: DataFrame, *month: str) -> DataFrame:
    """Flights per origin and day, cancelled ones included."""
    return grouped_count(flights, ["origin", "fl_date", *month], "origin")


def days_with_departures(days: DataFrame, counts: DataFrame) -> DataFrame:
    """Join on the day, newest day first.

    The day alone would order the result but put a busy day on one task; the other
    columns are added so that the sort can split it. They are unique together.
    """
    joined = join_on_day(days, counts, "daterep", "fl_date")
    return joined.select(*COLUMNS).orderBy(
        F.col("daterep").desc(), "origin", "country", "cases", "deaths"
    )


def daily_impact(
    cases: DataFrame,
    flights: DataFrame,
    country: str = COUNTRY,
    *,
    month: tuple[str, str] | None = None,
) -> DataFrame:
    """How many flights left each origin on the days with reported cases.

    ``month`` names the year and month columns of ``flights`` when it is partitioned
    by them and they follow from ``fl_date``; months without cases are then not read.
    """
    days = country_days(cases, country)
    if month:
        flights = only_months_of(flights, *month, days, "daterep")
    return days_with_departures(days, departures(flights))


def store_departures(flights: DataFrame, path: str, *, replace: str = "all") -> None:
    """Keep the departures per origin and day, so that questions need not scan flights."""
    counts = departures(flights, "year", "month").transform(add_month_partitions)
    write_by_month(counts, path, replace=replace)


def refresh_departures(spark: SparkSession, flights_path: str, path: str, since: date) -> None:
    """Recount the months from ``since`` on and replace only those; older data does not change."""
    flights = read_model(spark, flights_path, FLIGHTS, keep_partitions=True)
    first = since.year * 12 + since.month
    recent = flights.where(F.col("_year") * 12 + F.col("_month") >= first)
    store_departures(recent, path, replace="months")


def _store_buckets(df: DataFrame, spec: TableSpec, day: str, buckets: int, database: str | None) -> None:
    """Overwrite a table of one sorted file for each bucket of days.

    Days are hashed by the shuffle as they are by the buckets, so each task writes one file.
    """
    rows = df.select(*spec.column_names).repartition(buckets, day)
    (
        rows.write.format("parquet").mode("overwrite").bucketBy(buckets, day).sortBy(day)
        .saveAsTable(qualified(spec, database))
    )


def store_by_day(
    spark: SparkSession, cases: DataFrame, flights: DataFrame, buckets: int, database: str | None = None
) -> None:
    """Keep both sides of the daily question in tables that are joined without a shuffle.

    Both are aggregated: a day has one row for each origin, or each distinct report, so that
    no bucket is large for the sake of one day. ``buckets`` should make files of some 100 MB.
    """
    _store_buckets(departures(flights), DEPARTURES, "fl_date", buckets, database)
    days = distinct_rows(cases, "daterep", "country", "cases", "deaths")
    _store_buckets(days, CASE_DAYS, "daterep", buckets, database)


def daily_impact_by_day(spark: SparkSession, country: str = COUNTRY, database: str | None = None) -> DataFrame:
    """The daily question from the stored tables; only the sort of the answer shuffles."""
    days = read_table(spark, CASE_DAYS, database).where(F.col("country") == country)
    return days_with_departures(days, read_table(spark, DEPARTURES, database))
