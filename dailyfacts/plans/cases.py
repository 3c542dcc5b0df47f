"""Case job: nested JSON documents to month-partitioned Parquet."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import nullcontext

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dailyfacts.functions import lenient_int, parse_day, rejected
from dailyfacts.operators.aggregates import dedupe
from dailyfacts.operators.columns import add_month_partitions, explode_records, lower_names
from dailyfacts.operators.report import JobReport, timed
from dailyfacts.operators.writes import write_by_month
from dailyfacts.schemas import MONTH_PARTITIONS
from dailyfacts.session import sized_for
from dailyfacts.sources import read_case_documents, read_case_records

JOB = "load_covid"
INPUT = "covid19/download.json"
OUTPUT = "covid_parquet/covid.parquet"


# Fields that hold numbers, in text or as numbers.
NUMBERS = ("cases", "deaths", "day", "month", "year")


def parse_records(records: DataFrame) -> DataFrame:
    """Renamed and typed columns from rows with one ``record`` struct each.

    The texts they were parsed from stay in a struct ``raw``. Texts are taken out in a
    projection of their own, so that a variant is turned into text once and not once
    per use. A JSON number in exponent form is no such text and is read by its value.
    """
    kinds = {f.name: f.dataType.typeName() for f in records.schema["record"].dataType.fields}
    variants = [name for name in NUMBERS if kinds[name] == "variant"]
    texts = records.select(
        F.col("record.countriesAndTerritories").alias("country"),
        F.col("record.continentExp").alias("continent"),
        F.col("record.geoId"),
        F.col("record.dateRep"),
        *[F.col(f"record.{name}").cast("string").alias(name) for name in NUMBERS],
        *[F.col(f"record.{name}").alias(f"_{name}") for name in variants],
    )
    numbers = {
        name: F.coalesce(
            lenient_int(F.col(name)),
            *([F.try_variant_get(F.col(f"_{name}"), "$", "int")] if name in variants else []),
        ).alias(name)
        for name in NUMBERS
    }
    return texts.select(
        "country",
        "continent",
        "geoId",
        numbers["cases"],
        numbers["deaths"],
        parse_day(F.col("dateRep")).alias("dateRep"),
        numbers["day"],
        numbers["month"],
        numbers["year"],
        F.struct("dateRep", *NUMBERS).alias("raw"),
    )


def type_records(records: DataFrame) -> DataFrame:
    """The case table's columns and the partition columns, one row for each record, copies included."""
    return records.transform(parse_records).drop("raw").transform(lower_names).transform(add_month_partitions)


def finish_model(parsed: DataFrame) -> DataFrame:
    """Distinct rows; the partition columns are copies and added afterwards."""
    return parsed.drop("raw").transform(lower_names).transform(dedupe).transform(add_month_partitions)


def model_records(records: DataFrame) -> DataFrame:
    """The case table's columns and the partition columns, one row per distinct record."""
    return records.transform(parse_records).transform(finish_model)


def model_cases(documents: DataFrame) -> DataFrame:
    """Distinct case rows of all documents, ready to be written by month."""
    return documents.transform(explode_records).transform(model_records)


def _observe_rejects(parsed: DataFrame, seen: Observation) -> DataFrame:
    return parsed.observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        *[
            F.count_if(rejected(F.col(f"raw.{name}"), F.col(name))).alias(name)
            for name in ("dateRep", *NUMBERS)
        ],
    )


def load_cases(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    *,
    multi_line: bool = True,
    split: bool = False,
    cluster_by: Sequence[str] = MONTH_PARTITIONS,
    replace: str = "all",
    sized: bool = True,
) -> JobReport:
    """Read ``{input}/covid19/download.json``, write ``{output}/covid_parquet/covid.parquet``.

    With ``replace="months"`` or ``"changed"`` the input need only hold the months to be
    replaced, whole. With ``split`` each document is parsed by many tasks. The shuffle is sized
    for the job's own files unless the caller has done so.
    """
    source = f"{input_path}/{INPUT}"
    with timed(JobReport(JOB)) as report, sized_for(spark, source) if sized else nullcontext():
        seen = Observation()
        if split:
            records = read_case_records(spark, source)
        else:
            records = read_case_documents(spark, source, multi_line=multi_line).transform(explode_records)
        if records.isEmpty():
            # Before anything old is removed.
            raise ValueError(f"{source} holds no record; nothing was written")
        model = finish_model(_observe_rejects(records.transform(parse_records), seen))
        model.printSchema()
        path = f"{output_path}/{OUTPUT}"
        report.months = write_by_month(model, path, cluster_by=cluster_by, replace=replace)
        counts = dict(seen.get)
        report.rows_read = counts.pop("rows")
        report.rejects = counts
    return report
