"""Command line: run one job by name."""

from __future__ import annotations

import argparse
from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import SparkSession

from dailyfacts.operators.report import JobReport, timed
from dailyfacts.plans import flights
from dailyfacts.plans.cases import load_cases
from dailyfacts.plans.daily import refresh_departures
from dailyfacts.plans.flights import load_flights
from dailyfacts.plans.reload import reload_all
from dailyfacts.session import build_session


def _options(args: argparse.Namespace) -> tuple[dict, dict]:
    """Keywords of the case job and of the flights job."""
    both = {"replace": args.replace}
    if args.cluster_by:
        both["cluster_by"] = args.cluster_by
    case_options = {**both, "multi_line": not args.json_lines, "split": args.split_documents}
    return case_options, {**both, "check_header": not args.any_header}


def covid_job(spark: SparkSession, args: argparse.Namespace) -> None:
    load_cases(spark, args.input_data, args.output_data, **_options(args)[0])


def flights_job(spark: SparkSession, args: argparse.Namespace) -> None:
    load_flights(spark, args.input_data, args.output_data, **_options(args)[1])


def reload_job(spark: SparkSession, args: argparse.Namespace) -> None:
    """Reload everything and store the answer under ``{output}/daily_impact.parquet``."""
    case_options, flight_options = _options(args)
    answer = reload_all(
        spark, args.input_data, args.output_data,
        case_options=case_options, flight_options=flight_options, in_place=args.in_place,
    )
    answer.write.mode("overwrite").parquet(f"{args.output_data}/daily_impact.parquet")


def departures_job(spark: SparkSession, args: argparse.Namespace) -> None:
    """Recount the stored departures of the months from ``--since`` on, from the modelled flights."""
    refresh_departures(
        spark, f"{args.input_data}/{flights.OUTPUT}", f"{args.output_data}/departures.parquet", args.since
    )


JOBS: dict[str, Callable[[SparkSession, argparse.Namespace], object]] = {
    "load_covid": covid_job,
    "load_flights": flights_job,
    "reload": reload_job,
    "refresh_departures": departures_job,
}


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = argparse.ArgumentParser(description="Run a job")
    parser.add_argument("--job", required=True, choices=sorted(JOBS), help="job to run")
    parser.add_argument("--input-data", required=True, help="folder of the raw files")
    parser.add_argument("--output-data", required=True, help="folder to write to")
    form = parser.add_mutually_exclusive_group()
    form.add_argument("--json-lines", action="store_true", help="each line is a document; files are split")
    form.add_argument("--split-documents", action="store_true", help="many tasks parse one large document")
    parser.add_argument("--any-header", action="store_true", help="do not compare flight headers")
    parser.add_argument("--replace", choices=["all", "months", "changed"], default="all", help="what to overwrite")
    parser.add_argument("--in-place", action="store_true", help="reload drops the old tables first")
    parser.add_argument("--cluster-by", nargs="+", help="columns to bring together for the write")
    parser.add_argument("--since", type=date.fromisoformat, help="first day of refresh_departures")
    args = parser.parse_args(argv)
    if args.job == "refresh_departures" and args.since is None:
        parser.error("refresh_departures needs --since")
    print(f"job {args.job}, input {args.input_data}, output {args.output_data}")
    with timed(JobReport(f"{args.job} with session start")):
        spark = spark or build_session()
        JOBS[args.job](spark, args)
