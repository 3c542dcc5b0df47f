"""The whole reload: both jobs, nine tables, the gate, the daily question."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from dailyfacts.operators.publish import hide, publish_after
from dailyfacts.operators.quality import enforce, gate, null_rule
from dailyfacts.operators.tables import create_table, drop_table, load_table
from dailyfacts.plans import cases, flights
from dailyfacts.plans.daily import COUNTRY, daily_impact
from dailyfacts.schemas import CASES, FLIGHTS, LOOKUP_FILES, LOOKUPS, TABLES, TableSpec
from dailyfacts.session import sized_for
from dailyfacts.sources import read_lookup_file, read_model, read_table


def _together(spark: SparkSession, actions: list[Callable[[], object]]) -> None:
    """Run independent Spark actions at once, so that small loads fill idle executors."""
    with ThreadPoolExecutor(max_workers=8) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(action)) for action in actions]:
            done.result()


def recreate_tables(spark: SparkSession, database: str | None = None) -> None:
    for spec in TABLES.values():
        hide(spark, spec, database)
        drop_table(spark, spec, database)
    for spec in TABLES.values():
        create_table(spark, spec, database)


def load_tables(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    database: str | None = None,
    lookup_paths: Mapping[str, str] | None = None,
    into: Callable[[TableSpec], TableSpec] = lambda spec: spec,
) -> None:
    """Fill the nine empty tables from the written Parquet and the lookup files.

    ``into`` names the table that is filled for each. The gate columns are counted while the
    rows are written; a null in one of them fails the load.
    """
    paths = {name: f"{input_path}/flights/{file}" for name, file in LOOKUP_FILES.items()}
    paths.update(lookup_paths or {})
    facts = [(CASES, f"{output_path}/{cases.OUTPUT}"), (FLIGHTS, f"{output_path}/{flights.OUTPUT}")]
    loads = [(spec, read_model(spark, path, spec)) for spec, path in facts]
    loads += [(LOOKUPS[name], read_lookup_file(spark, path)) for name, path in paths.items()]

    def load(spec: TableSpec, df: DataFrame) -> None:
        rules = [null_rule(spec.gate)] if spec.gate else []
        enforce(spec.name, load_table(spark, into(spec), df, database, rules))

    _together(spark, [lambda s=spec, d=df: load(s, d) for spec, df in loads])


def check_tables(spark: SparkSession, database: str | None = None) -> None:
    """The gate as a scan of the loaded tables."""
    for spec in (CASES, FLIGHTS):
        gate(read_table(spark, spec, database), spec)


def daily_impact_of_tables(
    spark: SparkSession, country: str = COUNTRY, database: str | None = None
) -> DataFrame:
    return daily_impact(
        read_table(spark, CASES, database),
        read_table(spark, FLIGHTS, database),
        country,
        month=("year", "month"),
    )


def reload_all(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    *,
    country: str = COUNTRY,
    database: str | None = None,
    flights_path: str | None = None,
    lookup_paths: Mapping[str, str] | None = None,
    case_options: Mapping[str, object] | None = None,
    flight_options: Mapping[str, object] | None = None,
    in_place: bool = False,
) -> DataFrame:
    """Run the stages in order; a failed stage or check stops before the question is asked.

    The nine tables are filled beside those of the last reload and shown, as views, once all
    of them are loaded and have passed the gate: until then, and when it fails, readers get
    the old rows. ``in_place`` drops the old tables first and needs no second copy of them.

    All raw files are under ``input_path`` unless ``flights_path``, another input
    folder, or ``lookup_paths``, a file per lookup table, says otherwise. The options are
    keywords of ``load_cases`` and ``load_flights``. Shuffles are sized for the raw files of
    both jobs, which run at once.
    """
    of_flights = flights_path or input_path
    case_options = {**(case_options or {}), "sized": False}
    flight_options = {**(flight_options or {}), "sized": False}
    with sized_for(spark, [f"{input_path}/{cases.INPUT}", f"{of_flights}/{flights.INPUT}"]):
        _together(
            spark,
            [
                lambda: cases.load_cases(spark, input_path, output_path, **case_options),
                lambda: flights.load_flights(spark, of_flights, output_path, **flight_options),
            ],
        )
        if in_place:
            recreate_tables(spark, database)
            load_tables(spark, input_path, output_path, database, lookup_paths)
        else:
            fill = partial(load_tables, spark, input_path, output_path, database, lookup_paths)
            publish_after(spark, list(TABLES.values()), fill, database)
    return daily_impact_of_tables(spark, country, database)
