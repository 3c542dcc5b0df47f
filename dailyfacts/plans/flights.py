"""Flights job: typed CSV to month-partitioned Parquet."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import nullcontext

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dailyfacts.functions import flag_to_int, month_of, rejected, year_of
from dailyfacts.operators.aggregates import dedupe, dedupe_in_groups
from dailyfacts.operators.columns import add_month_partitions, lower_names
from dailyfacts.operators.report import JobReport, timed
from dailyfacts.operators.writes import write_by_month
from dailyfacts.schemas import FLIGHT_FILE_COLUMNS, MONTH_PARTITIONS, ddl
from dailyfacts.session import sized_for
from dailyfacts.sources import read_flight_files
from dailyfacts.sources.files import RAW_LINE, read_flight_days

JOB = "load_flights"
# The pattern keeps the lookup files of the same folder out of the scan.
INPUT = "flights/flights_*_*.csv"
OUTPUT = "flights_parquet/flights.parquet"


def _typed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("CANCELLED", flag_to_int(F.col("CANCELLED"))).transform(lower_names)


def _dated(rows: DataFrame) -> DataFrame:
    day = F.col("fl_date")
    return rows.withColumns({"year": year_of(day), "month": month_of(day)}).transform(add_month_partitions)


def model_flights(rows: DataFrame) -> DataFrame:
    """Distinct flight rows with year, month and an integer flag, ready to be written by month.

    The dedupe comes before the columns that follow from the date, so that they are not
    shuffled.
    """
    return rows.transform(_typed).transform(dedupe).transform(_dated)


def _month() -> Column:
    """A flight's month as one number."""
    day = F.col("fl_date")
    return year_of(day) * 12 + month_of(day)


def months_of(rows: DataFrame) -> DataFrame:
    """``month, n``: the months of the rows, as numbers, and how many rows they have; only dates are read."""
    return rows.groupBy(_month().alias("month")).agg(F.count(F.lit(1)).alias("n"))


def model_by_month(rows: DataFrame, months: DataFrame) -> DataFrame:
    """:func:`model_flights` in tasks that hold a month or a part of it each, or several small ones.

    The dedupe and the write by month share this one shuffle. ``months`` are those of the rows.
    """
    return rows.transform(_typed).transform(dedupe_in_groups, _month(), months).transform(_dated)


def _lost_fields(rows: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
    """The rows, and for each typed column whether its field was not blank and did not parse.

    Only lines with such a field are parsed again, as text.
    """
    names = [(name.upper(), "string") for name, _ in FLIGHT_FILE_COLUMNS]
    texts = rows.withColumn("_fields", F.from_csv(RAW_LINE, ddl(names)))
    typed = [name for name, kind in FLIGHT_FILE_COLUMNS if kind != "string"]
    lost = {n: rejected(F.col(f"_fields.{n.upper()}"), F.col(n.upper())) for n in typed}
    return texts, lost


def rejected_fields(rows: DataFrame) -> DataFrame:
    """``column, rejected`` for each typed column of rows that were read with their raw lines."""
    texts, lost = _lost_fields(rows)
    counts = texts.agg(*[F.count_if(bad).alias(name) for name, bad in lost.items()])
    lines = [F.struct(F.lit(n).alias("column"), F.col(n).alias("rejected")) for n in lost]
    return counts.select(F.inline(F.array(*lines)))


def _observe_rejects(rows: DataFrame, seen: Observation) -> DataFrame:
    texts, lost = _lost_fields(rows)
    counted = texts.observe(
        seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(bad).alias(n) for n, bad in lost.items()]
    )
    return counted.drop(RAW_LINE, "_fields")


def load_flights(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    *,
    check_header: bool = True,
    cluster_by: Sequence[str] = MONTH_PARTITIONS,
    replace: str = "all",
    sized: bool = True,
) -> JobReport:
    """Read ``{input}/flights/flights_*_*.csv``, write ``{output}/flights_parquet/flights.parquet``.

    With ``replace="months"`` or ``"changed"`` the input need only hold the months to be
    replaced, whole. The shuffle is sized for the job's own files unless the caller has done
    so. Fields that did not parse are counted in the same pass.
    """
    source = f"{input_path}/{INPUT}"
    with timed(JobReport(JOB)) as report, sized_for(spark, source) if sized else nullcontext():
        seen = Observation()
        rows = read_flight_files(spark, source, check_header=check_header, raw_line=True)
        observed = _observe_rejects(rows, seen)
        if tuple(cluster_by) == MONTH_PARTITIONS:
            days = read_flight_days(spark, source)
            model, cluster_by = model_by_month(observed, months_of(days)), ()
        else:
            model = model_flights(observed)
        model.printSchema()
        path = f"{output_path}/{OUTPUT}"
        report.months = write_by_month(model, path, cluster_by=cluster_by, replace=replace)
        counts = dict(seen.get)
        report.rows_read = counts.pop("rows")
        report.rejects = counts
    return report
