"""Sorted loads, loads that are published after their checks, rules counted during a load."""

import datetime as dt
import glob
import uuid
from dataclasses import replace

import pyarrow.parquet as pq
import pytest
from helpers import RECORD, conf, flight_line, write_cases, write_flights, write_lookups
from pyspark.sql import functions as F

from dailyfacts.operators.layout import file_ranges
from dailyfacts.operators.publish import (
    hide,
    new_load,
    of_load,
    publish,
    publish_after,
    published_load,
    shown_table,
)
from dailyfacts.operators.quality import QualityError, Rule, enforce, null_rule
from dailyfacts.operators.tables import (
    SORT_KEY,
    create_table,
    load_good_rows,
    load_table,
    ranges_of,
    read_range,
    record_ranges,
)
from dailyfacts.plans.reload import reload_all
from dailyfacts.schemas import CASES, FLIGHTS, LOOKUPS, TABLES
from dailyfacts.sources import read_table

DAY = dt.date(2020, 3, 1)
#: Small files, so that a few thousand rows are many of them.
SMALL = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
}


@pytest.fixture
def database(spark, tmp_path):
    name = f"db_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/db'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def case_rows(spark, n, country, month=3):
    number = F.col("id").cast("int")
    return spark.range(n).select(
        country.cast("string").alias("country"), F.lit("c").alias("continent"), F.lit("g").alias("geoid"),
        number.alias("cases"), F.lit(1).alias("deaths"), F.lit(DAY).alias("daterep"), F.lit(1).alias("day"),
        F.lit(month).alias("month"), F.lit(2020).alias("year"),
    )


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def hot_months(spark):
    """A hot month with a hot country, and two small months."""
    country = F.when(F.col("id") % 2 == 0, "K").otherwise(F.chr((65 + F.col("id") % 26).cast("int")))
    return case_rows(spark, 6000, country).union(case_rows(spark, 40, F.lit("B"), 1)).union(
        case_rows(spark, 40, F.lit("C"), 2)
    )


def test_files_of_a_hot_month_cover_separate_countries(spark, database, tmp_path):
    with conf(spark, SMALL):
        create_table(spark, CASES, database)
        load_table(spark, CASES, hot_months(spark), database)
    files = glob.glob(f"{tmp_path}/db/covid/month=3/year=2020/*.parquet")
    spans = []
    for file in files:
        countries = pq.ParquetFile(file).read().column("country").to_pylist()
        assert countries == sorted(countries)
        spans.append((countries[0], countries[-1]))
    spans.sort()
    assert len(spans) > 4
    # Files only share the country at which one ends and the next begins.
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    assert sum(low <= "K" <= high for low, high in spans) > 2
    assert read_table(spark, CASES, database).count() == 6080


def test_the_sort_key_is_recorded(spark, database):
    create_table(spark, CASES, database)
    load_table(spark, CASES, hot_months(spark), database)
    properties = dict(map(tuple, spark.sql(f"SHOW TBLPROPERTIES {database}.covid").collect()))
    assert properties[SORT_KEY] == "year,month,country"
    ranges = read_table(spark, ranges_of(CASES), database)
    assert ranges.agg(F.sum("rows")).first()[0] == 6080
    assert rows(ranges) == rows(file_ranges(read_table(spark, CASES, database), *CASES.sort_by))


def test_a_range_is_read_from_its_files_only(spark, database, tmp_path):
    with conf(spark, SMALL):
        create_table(spark, CASES, database)
        load_table(spark, CASES, hot_months(spark).where("country <= 'M'"), database)
        load_table(spark, CASES, case_rows(spark, 500, F.lit("Z")).union(case_rows(spark, 9, F.lit(None))), database)
    expected = read_table(spark, CASES, database).where("country between 'A' and 'C'").count()
    for file in glob.glob(f"{tmp_path}/db/covid/month=*/year=*/*.parquet"):
        countries = pq.ParquetFile(file).read().column("country").to_pylist()
        if all(c is None or c > "C" for c in countries):
            # A scan that opened the file would fail.
            with open(file, "wb") as broken:
                broken.write(b"no parquet")
    assert read_range(spark, CASES, "country", "A", "C", database).count() == expected > 0
    with pytest.raises(Exception, match="(?i)parquet"):
        read_table(spark, CASES, database).where("country between 'A' and 'C'").count()


def test_files_that_are_not_recorded_are_read(spark, database):
    create_table(spark, CASES, database)
    load_table(spark, CASES, case_rows(spark, 5, F.lit("A")), database)
    late = case_rows(spark, 3, F.lit("A"))
    spark.sql(f"INSERT INTO {database}.covid BY NAME SELECT * FROM {{late}}", late=late)
    assert read_range(spark, CASES, "country", "A", "A", database).count() == 8
    record_ranges(spark, CASES, database)
    assert read_range(spark, CASES, "country", "B", "C", database).count() == 0
    with pytest.raises(ValueError, match="not in the sort key"):
        read_range(spark, CASES, "deaths", 1, 2, database)


def test_an_empty_sorted_table(spark, database):
    create_table(spark, CASES, database)
    load_table(spark, CASES, case_rows(spark, 0, F.lit("A")), database)
    assert read_range(spark, CASES, "country", "A", "Z", database).count() == 0


def test_rules_are_counted_once_while_loading(spark, database):
    rules = [null_rule(["country"]), null_rule(["deaths"]), Rule("large", F.col("cases") >= 90)]
    df = case_rows(spark, 100, F.when(F.col("id") % 10 > 0, F.lit("x")))
    for spec in (CASES, replace(CASES, name="unsorted", sort_by=())):
        create_table(spark, spec, database)
        found = load_table(spark, spec, df, database, rules)
        assert [(r.rule, r.actual, r.passed) for r in found] == [
            ("country is null", 10, False), ("deaths is null", 0, True), ("large", 10, False)
        ]
    with pytest.raises(ValueError, match="only expect 0"):
        load_table(spark, CASES, df, database, [Rule("all", F.lit(True), expected=100)])
    assert load_table(spark, CASES, df, database) == []


def test_a_counted_load_has_one_scan(spark, database, tmp_path):
    case_rows(spark, 10, F.lit("x")).write.parquet(str(tmp_path / "in"))
    spec = replace(CASES, sort_by=())
    create_table(spark, spec, database)
    group = f"g{uuid.uuid4().hex}"
    spark.sparkContext.setJobGroup(group, "load")
    load_table(spark, spec, spark.read.schema("country string, continent string, geoid string, cases int,"
               " deaths int, daterep date, day int, month int, year int").parquet(str(tmp_path / "in")),
               database, [null_rule(["country"])])
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) == 1


def test_rows_without_a_required_column_are_set_aside(spark, database, tmp_path):
    spec = replace(CASES, required=("country", "deaths"))
    create_table(spark, spec, database)
    read = spark.sparkContext.accumulator(0)
    country = F.when(F.col("id") % 4 > 0, F.lit("x"))
    df = case_rows(spark, 40, country).withColumn("deaths", F.when(F.col("cases") % 3 > 0, F.col("cases")))
    counted = df.rdd.map(lambda row: (read.add(1), row)[1]).toDF(df.schema)
    found = load_good_rows(spark, spec, counted, str(tmp_path / "bad"), database, [null_rule(["country"])])
    assert [r.actual for r in found] == [0]
    # Two writes and the ranges, but every row was computed once.
    assert read.value == 40
    assert read_table(spark, spec, database).count() == 20
    missing = spark.read.parquet(str(tmp_path / "bad")).groupBy("missing").count().collect()
    assert {tuple(r.missing): r["count"] for r in missing} == {("country",): 6, ("deaths",): 10, ("country", "deaths"): 4}


def fill_with(spark, spec, df, database, *rules):
    return lambda into: enforce(spec.name, load_table(spark, into(spec), df, database, rules))


def test_a_failed_gate_leaves_the_old_rows(spark, database):
    old, bad = case_rows(spark, 5, F.lit("old")), case_rows(spark, 7, F.lit(None))
    rule = null_rule(CASES.gate)
    first = publish_after(spark, [CASES], fill_with(spark, CASES, old, database, rule), database)
    assert published_load(spark, CASES, database) == first
    tables = spark.sql(f"SHOW TABLES IN {database}").count()
    with pytest.raises(QualityError, match="7 not matching 0"):
        publish_after(spark, [CASES], fill_with(spark, CASES, bad, database, rule), database)
    assert read_table(spark, CASES, database).select("country").distinct().collect() == [("old",)]
    assert published_load(spark, CASES, database) == first
    assert spark.sql(f"SHOW TABLES IN {database}").count() == tables


def test_readers_of_the_last_load_can_finish(spark, database):
    def load(n):
        df = case_rows(spark, n, F.lit("x"))
        return publish_after(spark, [CASES], fill_with(spark, CASES, df, database), database)

    first = load(1)
    begun = read_table(spark, shown_table(spark, CASES, database), database)
    second = load(2)
    assert begun.count() == 1 and read_table(spark, CASES, database).count() == 2
    third = load(3)
    assert read_range(spark, shown_table(spark, CASES, database), "country", "x", "x", database).count() == 3
    names = {r.tableName for r in spark.sql(f"SHOW TABLES IN {database}").collect()}
    assert names == {"covid"} | {f"covid__{x}{e}" for x in (second, third) for e in ("", "__files")}
    assert first < second < third
    hide(spark, CASES, database)
    assert spark.sql(f"SHOW TABLES IN {database}").count() == 0


def test_publishing_is_taken_back_when_a_name_fails(spark, database):
    specs = [LOOKUPS["cancellation"], LOOKUPS["state_fips"]]
    lookup = spark.createDataFrame([("1", "one")], "code string, description string")

    def fill(into):
        for spec in specs:
            load_table(spark, into(spec), lookup, database)

    first = publish_after(spark, specs, fill, database)
    broken = new_load()
    create_table(spark, of_load(specs[0], broken), database)
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        publish(spark, specs, broken, database)
    assert [published_load(spark, s, database) for s in specs] == [first, first]
    assert all(read_table(spark, s, database).count() == 1 for s in specs)


def test_a_view_takes_the_place_of_a_plain_table(spark, database):
    create_table(spark, CASES, database)
    load_table(spark, CASES, case_rows(spark, 2, F.lit("plain")), database)
    assert published_load(spark, CASES, database) is None
    assert shown_table(spark, CASES, database) == CASES
    publish_after(spark, [CASES], fill_with(spark, CASES, case_rows(spark, 3, F.lit("new")), database), database)
    assert read_table(spark, CASES, database).count() == 3


def _raw(path, **record):
    write_cases(path, [RECORD, {**RECORD, "deaths": "3", **record}])
    write_flights(path, [flight_line(TAIL_NUM=f"M{i}") for i in range(3)])
    write_lookups(path)
    return str(path)


def test_a_reload_that_fails_leaves_all_nine_tables(spark, database, tmp_path):
    good, bad = _raw(tmp_path / "a"), _raw(tmp_path / "b", dateRep="soon")
    assert reload_all(spark, good, good, database=database).count() == 2
    with pytest.raises(QualityError, match="covid: country is null or daterep is null: 1 not matching 0"):
        reload_all(spark, bad, bad, database=database)
    assert {n: spark.table(f"{database}.{n}").count() for n in TABLES} == {**dict.fromkeys(TABLES, 2), "flights": 3}
    # In place, the old tables go first.
    assert reload_all(spark, good, good, database=database, in_place=True).count() == 2
    assert spark.catalog.getTable(f"{database}.covid").tableType == "MANAGED"
    with pytest.raises(QualityError):
        reload_all(spark, bad, bad, database=database, in_place=True)
    assert spark.table(f"{database}.covid").count() == 2
    assert {r.tableName for r in spark.sql(f"SHOW TABLES IN {database}").collect()} == {*TABLES, "covid__files"}
    assert FLIGHTS.sort_by == ()
