"""The jobs and the whole reload, from raw files made of the benchmark tables."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dailyfacts import cli
from dailyfacts.catalogue.raw import (
    BROKEN_FIELDS,
    CASES_SQL,
    DIRTY_CASES_SQL,
    FLIGHT_ROWS_SQL,
    FLIGHTS_SQL,
    LOOKUP_ORIGINS,
    lookup_file,
    raw_case_lines,
    raw_broken_flights,
    raw_cases,
    raw_dirty_cases,
    raw_flights,
    raw_lookups,
    raw_split_document,
    write_flight_files,
)
from dailyfacts.catalogue.registry import query, table
from dailyfacts.catalogue.tables import scratch_database
from dailyfacts.functions import flag_to_int
from dailyfacts.operators.columns import lower_names
from dailyfacts.operators.joins import only_months_of
from dailyfacts.operators.publish import publish_after
from dailyfacts.plans import cases, flights
from dailyfacts.plans.daily import (
    country_days,
    daily_impact_by_day,
    days_with_departures,
    refresh_departures,
    store_by_day,
    store_departures,
)
from dailyfacts.plans.describe import describe_flights
from dailyfacts.plans.reload import load_tables, reload_all
from dailyfacts.schemas import CASES, FLIGHTS, LOOKUPS
from dailyfacts.session import scratch_path
from dailyfacts.sources import read_flight_files, read_lookup_file, read_model, read_table

COUNTRY = "5-LOW"

_DAILY_SQL = f"""
with days as (
  select daterep, country, cases, deaths from ({CASES_SQL}) where country = '{COUNTRY}'
  group by daterep, country, cases, deaths
), counts as (
  select origin, fl_date, count(origin) as num from ({FLIGHTS_SQL}) group by origin, fl_date
)
select * from days join counts on daterep = fl_date order by daterep desc
"""


@query(f"select *, year as _year, month as _month from ({CASES_SQL})")
def case_job(spark, sf_dir):
    """The case job from JSON documents to Parquet, read back with its partitions."""
    path = scratch_path(spark, "case-job")
    cases.load_cases(spark, raw_cases(spark, sf_dir), path)
    return read_model(spark, f"{path}/{cases.OUTPUT}", CASES, keep_partitions=True)


@query(f"select *, year as _year, month as _month from ({FLIGHTS_SQL})")
def flight_job(spark, sf_dir):
    """The flights job from CSV to Parquet, read back with its partitions."""
    path = scratch_path(spark, "flight-job")
    flights.load_flights(spark, raw_flights(spark, sf_dir), path)
    return read_model(spark, f"{path}/{flights.OUTPUT}", FLIGHTS, keep_partitions=True)


@query(_DAILY_SQL)
def star_schema_reload(spark, sf_dir):
    """Both jobs, nine tables, the gate, and the daily question, from raw files."""
    lookups = raw_lookups(spark, sf_dir)
    return reload_all(
        spark,
        raw_cases(spark, sf_dir),
        scratch_path(spark, "reload"),
        flights_path=raw_flights(spark, sf_dir),
        lookup_paths={name: lookup_file(lookups, name) for name in LOOKUPS},
        country=COUNTRY,
        database=scratch_database(spark),
    )


@query(_DAILY_SQL)
def stored_departures(spark, sf_dir):
    """The daily question from stored counts whose last months were counted again."""
    path = scratch_path(spark, "stored")
    cases.load_cases(spark, raw_cases(spark, sf_dir), path)
    flights.load_flights(spark, raw_flights(spark, sf_dir), path)
    fact, counts = f"{path}/{flights.OUTPUT}", f"{path}/departures.parquet"
    store_departures(read_model(spark, fact, FLIGHTS), counts)
    refresh_departures(spark, fact, counts, since=date(2001, 6, 1))
    days = country_days(read_model(spark, f"{path}/{cases.OUTPUT}", CASES), COUNTRY)
    stored = only_months_of(spark.read.parquet(counts), "_year", "_month", days, "daterep")
    return days_with_departures(days, stored)


_CODES = ["origin_airport_id", "dest_airport_id", "origin_airport_seq_id"]


@query(f"""
with flights as ({FLIGHT_ROWS_SQL} union all {FLIGHT_ROWS_SQL})
select fl_date, tail_num, origin_airport_id, dest_airport_id, origin_airport_seq_id,
  o.p_name || ', "' || cast(o.p_partkey as string) || '"' as origin_airport_id_description,
  d.p_name || ', "' || cast(d.p_partkey as string) || '"' as dest_airport_id_description,
  s_name || ', "' || cast(s_suppkey as string) || '"' as origin_airport_seq_id_description
from flights
left join part o on origin_airport_id = o.p_partkey
left join part d on dest_airport_id = d.p_partkey
left join supplier on origin_airport_seq_id = s_suppkey
""")
def described_flights(spark, sf_dir):
    """Raw flight rows with the descriptions of three of their codes, from lookup files."""
    files = raw_lookups(spark, sf_dir)
    lookups = {name: read_lookup_file(spark, lookup_file(files, name)) for name in LOOKUPS}
    rows = read_flight_files(spark, f"{raw_flights(spark, sf_dir)}/{flights.INPUT}")
    coded = lower_names(rows).select("fl_date", "tail_num", *_CODES)
    return describe_flights(coded, lookups, _CODES)


@query(f"select *, year as _year, month as _month from ({CASES_SQL})")
def case_lines_job(spark, sf_dir):
    """The case job from documents of one line each."""
    path = scratch_path(spark, "case-lines-job")
    cases.load_cases(spark, raw_case_lines(spark, sf_dir), path, multi_line=False)
    return read_model(spark, f"{path}/{cases.OUTPUT}", CASES, keep_partitions=True)


@query(f"select *, year as _year, month as _month from ({CASES_SQL})")
def case_split_job(spark, sf_dir):
    """The case job from one document of all cases, parsed by many tasks."""
    path = scratch_path(spark, "case-split-job")
    cases.load_cases(spark, raw_split_document(spark, sf_dir), path, split=True)
    return read_model(spark, f"{path}/{cases.OUTPUT}", CASES, keep_partitions=True)


_LATE = date(1998, 6, 1)
_REFRESHED_SQL = f"""
select *, year as _year, month as _month from (
  select distinct * replace (case when fl_date >= date '1998-06-01' then 'ZZ' else tail_num end as tail_num)
  from ({FLIGHTS_SQL})
)
"""


def _late_tail(spark, sf_dir, path, *, only_late):
    """Raw flights with another tail number since ``_LATE``, or these flights only."""
    late = F.col("l_shipdate").cast("date") >= _LATE
    lineitem = table(spark, sf_dir, "lineitem")
    write_flight_files(
        lineitem.where(late) if only_late else lineitem, path,
        {"tail_num": lambda tail: F.when(late, "ZZ").otherwise(tail)},
    )


@query(_REFRESHED_SQL)
def month_refresh_job(spark, sf_dir):
    """The flights job twice; the second time only the months with other rows are written."""
    path, changed = scratch_path(spark, "refresh"), scratch_path(spark, "changed-flights")
    flights.load_flights(spark, raw_flights(spark, sf_dir), path, replace="changed")
    _late_tail(spark, sf_dir, changed, only_late=False)
    flights.load_flights(spark, changed, path, replace="changed")
    return read_model(spark, f"{path}/{flights.OUTPUT}", FLIGHTS, keep_partitions=True)


@query("""
with days as (
  select cast(o_orderdate as date) as daterep, o_orderstatus as country,
    cast(trunc(o_totalprice) as integer) as cases, cast(o_custkey % 100000 as integer) as deaths
  from orders where o_orderstatus = 'F' group by 1, 2, 3, 4
), counts as (
  select l_returnflag as origin, cast(l_shipdate as date) as fl_date, count(l_returnflag) as num
  from lineitem group by 1, 2
)
select * from days join counts on daterep = fl_date order by daterep desc
""")
def bucketed_departures(spark, sf_dir):
    """The daily question from two stored tables with the same buckets of days."""
    database = scratch_database(spark)
    reports = table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").cast("date").alias("daterep"), F.col("o_orderstatus").alias("country"),
        flag_to_int(F.col("o_totalprice")).alias("cases"), (F.col("o_custkey") % 100000).cast("int").alias("deaths"),
    )
    departed = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("origin"), F.col("l_shipdate").cast("date").alias("fl_date")
    )
    store_by_day(spark, reports, departed, 8, database)
    return daily_impact_by_day(spark, "F", database)


_LOOKUPS_SQL = " union all ".join(
    f"""select '{name}' as lookup, cast({code} as string) as code,
      concat({description}, ', "', cast({code} as string), '"') as description from {origin}"""
    for name, (origin, code, description) in LOOKUP_ORIGINS.items()
)


@query(_LOOKUPS_SQL)
def loaded_lookups(spark, sf_dir):
    """All seven lookup tables, as the reload fills them from their files."""
    database, raw = scratch_database(spark), raw_lookups(spark, sf_dir)
    path = scratch_path(spark, "lookups-model")
    cases.load_cases(spark, raw_cases(spark, sf_dir), path)
    flights.load_flights(spark, raw_flights(spark, sf_dir), path)

    def fill(into):
        load_tables(spark, raw, path, database, into=into)

    publish_after(spark, [CASES, FLIGHTS, *LOOKUPS.values()], fill, database)
    loaded = [
        read_table(spark, spec, database).select(F.lit(name).alias("lookup"), "code", "description")
        for name, spec in LOOKUPS.items()
    ]
    return reduce(DataFrame.union, loaded)


@query(f"select *, year as _year, month as _month from ({DIRTY_CASES_SQL})")
def dirty_case_job(spark, sf_dir):
    """The case job from records that come twice and hold days and counts that are lost."""
    path = scratch_path(spark, "dirty-job")
    cases.load_cases(spark, raw_dirty_cases(spark, sf_dir), path, multi_line=False)
    return read_model(spark, f"{path}/{cases.OUTPUT}", CASES, keep_partitions=True)


@query(_REFRESHED_SQL)
def command_line_refresh(spark, sf_dir):
    """The flights job from its command line, and again with the last months only."""
    path, last = scratch_path(spark, "command-line"), scratch_path(spark, "last-flights")
    _late_tail(spark, sf_dir, last, only_late=True)
    for source, replace in ((raw_flights(spark, sf_dir), "all"), (last, "months")):
        arguments = ["--job", "load_flights", "--input-data", source, "--output-data", path, "--replace", replace]
        cli.main(arguments, spark)
    return read_model(spark, f"{path}/{flights.OUTPUT}", FLIGHTS, keep_partitions=True)


@query("select 'rows' as what, count(*) as n from lineitem union all " + " union all ".join(
    f"select '{name}', count(*) from lineitem where {where}" for name, (where, _) in BROKEN_FIELDS.items()
))
def job_report(spark, sf_dir):
    """What the flights job reports: rows read, and fields of each column that were lost."""
    report = flights.load_flights(spark, raw_broken_flights(spark, sf_dir), scratch_path(spark, "report-job"))
    lost = [(name, n) for name, n in report.rejects.items() if n]
    return spark.createDataFrame([("rows", report.rows_read), *lost], "what string, n long")
