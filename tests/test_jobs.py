import datetime as dt
import glob
import json

import pytest
from helpers import RECORD, conf, flight_line, write_cases, write_flights, write_lookups
from pyspark.sql import functions as F

from dailyfacts.cli import JOBS, main
from dailyfacts.operators.aggregates import dedupe_in_groups
from dailyfacts.operators.publish import hide
from dailyfacts.operators.quality import QualityError
from dailyfacts.plans import cases, flights
from dailyfacts.plans.daily import COUNTRY, refresh_departures, store_departures
from dailyfacts.plans.describe import describe_flights_of_tables
from dailyfacts.plans.reload import reload_all
from dailyfacts.schemas import CASES, FLIGHTS, LOOKUPS_BY_FLIGHT_COLUMN, MONTH_PARTITIONS, TABLES
from dailyfacts.session import build_session, input_bytes, scratch_path, size_for_input
from dailyfacts.sources import read_model

DAY = dt.date(2020, 3, 1)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def database(spark, tmp_path):
    name = "reload_" + tmp_path.name.replace("-", "_")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/db'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_case_job(spark, tmp_path):
    records = [
        RECORD,
        dict(RECORD),
        {**RECORD, "cases": "", "dateRep": "1/3/2020"},
        {**RECORD, "cases": "many", "deaths": 4, "dateRep": "31/02/2020"},
        {**RECORD, "year": None, "month": None, "cases": "12.0"},
    ]
    write_cases(tmp_path, records)
    for _ in range(2):
        report = cases.load_cases(spark, str(tmp_path), str(tmp_path / "out"))
        model = read_model(spark, f"{tmp_path}/out/{cases.OUTPUT}", CASES, keep_partitions=True)
        start = (COUNTRY, "America", "US")
        assert rows(model) == sorted(
            [
                (*start, 10, 1, DAY, 1, 3, 2020, 2020, 3),
                (*start, None, 1, DAY, 1, 3, 2020, 2020, 3),
                (*start, None, 4, None, 1, 3, 2020, 2020, 3),
                (*start, 12, 1, DAY, 1, None, None, None, None),
            ],
            key=repr,
        )
    assert report.job == "load_covid" and report.seconds > 0 and report.rows_read == 5
    assert {k: v for k, v in report.rejects.items() if v} == {"cases": 1, "dateRep": 1}
    assert glob.glob(f"{tmp_path}/out/{cases.OUTPUT}/_year=__HIVE_DEFAULT_PARTITION__/*/*.parquet")


def test_case_job_clustered_by_continent(spark, tmp_path):
    write_cases(tmp_path, [{**RECORD, "continentExp": c} for c in "abc"])
    cases.load_cases(spark, str(tmp_path), str(tmp_path), cluster_by=("continent",))
    assert read_model(spark, f"{tmp_path}/{cases.OUTPUT}", CASES).count() == 3


def test_flight_job(spark, tmp_path):
    write_flights(tmp_path, [flight_line(), flight_line(), flight_line(CANCELLED="1.00", CANCELLATION_CODE="B")])
    write_flights(tmp_path, [flight_line(FL_DATE="2020-02-29"), flight_line(FL_DATE="x")], "flights_2020_02.csv")
    write_lookups(tmp_path)
    for _ in range(2):
        flights.load_flights(spark, str(tmp_path), str(tmp_path))
        model = read_model(spark, f"{tmp_path}/{flights.OUTPUT}", FLIGHTS, keep_partitions=True)
        assert model.columns == [*FLIGHTS.column_names, "_year", "_month"]
        got = model.select("fl_date", "cancelled", "cancellation_code", "year", "month", "_year", "_month")
        assert rows(got) == sorted(
            [
                (DAY, 0, None, 2020, 3, 2020, 3),
                (DAY, 1, "B", 2020, 3, 2020, 3),
                (dt.date(2020, 2, 29), 0, None, 2020, 2, 2020, 2),
                (None, 0, None, None, None, None, None),
            ],
            key=repr,
        )


def test_partition_filter_skips_folders(spark, tmp_path):
    write_flights(tmp_path, [flight_line(), flight_line(FL_DATE="2020-02-29")])
    flights.load_flights(spark, str(tmp_path), str(tmp_path))
    march = read_model(spark, f"{tmp_path}/{flights.OUTPUT}", FLIGHTS, keep_partitions=True).where("_month = 3")
    plan = march._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_month" in plan
    assert len(march.select("fl_date").collect()) == 1


def _raw(tmp_path, **flight):
    write_cases(tmp_path, [RECORD, {**RECORD, "deaths": "3"}, {**RECORD, "countriesAndTerritories": "Italy"}])
    lines = [flight_line(TAIL_NUM=f"M{i}") for i in range(3)]
    write_flights(tmp_path, [*lines, flight_line(ORIGIN="SFO", FL_DATE="2020-03-02"), flight_line(**flight)])
    write_lookups(tmp_path)
    return str(tmp_path)


def test_reload(spark, tmp_path, database):
    path = _raw(tmp_path)
    for _ in range(2):
        answer = reload_all(spark, path, path, database=database)
        assert [tuple(r) for r in answer.collect()] == [
            (DAY, COUNTRY, 10, 1, "JFK", DAY, 4),
            (DAY, COUNTRY, 10, 3, "JFK", DAY, 4),
        ]
        counts = {name: spark.table(f"{database}.{name}").count() for name in TABLES}
        assert counts == {**{name: 2 for name in TABLES}, "covid": 3, "flights": 5}
    described = describe_flights_of_tables(spark, LOOKUPS_BY_FLIGHT_COLUMN, database)
    assert len(described.columns) == 33 + 13 and described.count() == 5
    names = [f"{c}_description" for c in ("origin_airport_id", "dest_airport_id", "cancellation_code")]
    assert described.select(*names).distinct().collect() == [('New York, NY: "JFK"', None, None)]


def test_reload_stops_at_the_loader(spark, tmp_path, database):
    path = _raw(tmp_path, DEST="")
    with pytest.raises(Exception, match="flights.dest is null"):
        reload_all(spark, path, path, database=database)


def test_reload_stops_at_the_gate(spark, tmp_path, database):
    path = _raw(tmp_path)
    write_cases(tmp_path, [RECORD, {**RECORD, "dateRep": "soon"}])
    with pytest.raises(QualityError, match="covid: country is null or daterep is null: 1 not matching 0"):
        reload_all(spark, path, path, database=database)


def test_stored_departures_follow_changed_months(spark, tmp_path):
    path = str(tmp_path)
    fact, counts = f"{path}/{flights.OUTPUT}", f"{path}/departures"
    write_flights(tmp_path, [flight_line(), flight_line(FL_DATE="2020-02-29")])
    flights.load_flights(spark, path, path)
    store_departures(read_model(spark, fact, FLIGHTS), counts)
    write_flights(tmp_path, [flight_line(TAIL_NUM=t) for t in "abc"])
    flights.load_flights(spark, path, path)
    refresh_departures(spark, fact, counts, since=DAY)
    stored = spark.read.parquet(counts).select("origin", "fl_date", "num")
    assert rows(stored) == sorted([("JFK", DAY, 3), ("JFK", dt.date(2020, 2, 29), 1)], key=repr)


def test_command_line(spark, tmp_path, capsys):
    path = _raw(tmp_path)
    main(["--job", "load_flights", "--input-data", path, "--output-data", path], spark)
    assert glob.glob(f"{path}/{flights.OUTPUT}/_year=2020/_month=3/*.parquet")
    assert "job load_flights took" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        main(["--job", "other", "--input-data", path, "--output-data", path], spark)
    with pytest.raises(SystemExit):
        main(["--job", "load_flights"], spark)
    assert set(JOBS) == {"load_covid", "load_flights", "refresh_departures", "reload"}


def test_command_line_recounts_departures(spark, tmp_path):
    path = _raw(tmp_path)
    main(["--job", "load_flights", "--input-data", path, "--output-data", path, "--replace", "months"], spark)
    refresh = ["--job", "refresh_departures", "--input-data", path, "--output-data", path]
    with pytest.raises(SystemExit):
        main(refresh, spark)
    main([*refresh, "--since", "2020-01-01"], spark)
    assert spark.read.parquet(f"{path}/departures.parquet").agg(F.sum("num")).first()[0] > 0


def test_numbers_in_exponent_form_and_json_lines(spark, tmp_path):
    record = {"countriesAndTerritories": "X", "dateRep": "1/3/2020", "day": 1, "month": 3, "year": 2020}
    lines = [
        json.dumps({"records": [{**record, "deaths": "1.2e7"}]})[:-3] + f', "cases": {n}}}]}}'
        for n in ("1.2e7", "15E6", "5.7")
    ]
    file = tmp_path / cases.INPUT
    file.parent.mkdir(parents=True)
    file.write_text("\n".join(lines))
    main(["--job", "load_covid", "--input-data", str(tmp_path), "--output-data", str(tmp_path), "--json-lines"], spark)
    found = spark.read.parquet(f"{tmp_path}/{cases.OUTPUT}").select("cases", "deaths").collect()
    assert sorted(map(tuple, found)) == [(5, None), (12_000_000, None), (15_000_000, None)]


def test_command_line_reload(spark, tmp_path):
    path = _raw(tmp_path)
    main(["--job", "reload", "--input-data", path, "--output-data", path], spark)
    assert spark.read.parquet(f"{path}/daily_impact.parquet").count() == 2
    for spec in TABLES.values():
        hide(spark, spec)


def test_session_and_scratch(spark):
    assert build_session(spark__sql__shuffle__partitions="4").sparkContext is spark.sparkContext
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first.startswith(spark.conf.get("spark.checkpoint.dir") + "/dailyfacts-x-")
    assert first != second


def test_sizes_follow_the_input(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "f.csv").write_bytes(b"x" * 1000)
    (tmp_path / "g.csv").write_bytes(b"x" * 24)
    assert input_bytes(spark, str(tmp_path)) == 1024
    keys = {"spark.sql.shuffle.partitions": "4", "spark.sql.files.maxPartitionBytes": "128MB"}
    with conf(spark, keys):
        size_for_input(spark, str(tmp_path))
        assert {key: spark.conf.get(key) for key in keys} == keys
        size_for_input(spark, str(tmp_path), partition_bytes=100)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "11"
        size_for_input(spark, str(tmp_path), partition_bytes=1, max_partitions=20)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "20"


def test_last_months_replace_only_themselves(spark, tmp_path):
    old, new, out = tmp_path / "old", tmp_path / "new", str(tmp_path)
    write_flights(old, [flight_line(), flight_line(FL_DATE="2020-02-29")])
    write_flights(new, [flight_line(TAIL_NUM="M1"), flight_line(TAIL_NUM="M2")])
    flights.load_flights(spark, str(old), out)
    for _ in range(2):
        flights.load_flights(spark, str(new), out, replace="months")
        model = read_model(spark, f"{out}/{flights.OUTPUT}", FLIGHTS)
        assert rows(model.select("month", "tail_num")) == [(2, "N1"), (3, "M1"), (3, "M2")]


def test_a_flights_load_shuffles_its_rows_once(spark, tmp_path, monkeypatch):
    lines = [flight_line(DEP_DELAY="0.0"), flight_line(DEP_DELAY="-0.0"), flight_line(DEP_DELAY="late"), flight_line(DEP_DELAY="")]
    write_flights(tmp_path, [*lines, *lines, flight_line(FL_DATE=""), flight_line(FL_DATE="2020-04-01")])
    calls, write = [], flights.write_by_month
    monkeypatch.setattr(flights, "write_by_month", lambda df, *a, **k: calls.append((df, k)) or write(df, *a, **k))
    found = []
    for replace, keys in (("all", MONTH_PARTITIONS), ("changed", MONTH_PARTITIONS), ("all", ["origin"]), ("all", [])):
        report = flights.load_flights(spark, str(tmp_path), f"{tmp_path}/{replace}", replace=replace, cluster_by=keys)
        assert report.rows_read == 10 and {n: v for n, v in report.rejects.items() if v} == {"dep_delay": 2}
        found.append(rows(read_model(spark, f"{tmp_path}/{replace}/{flights.OUTPUT}", FLIGHTS, keep_partitions=True)))
        plan = calls[-1][0]._jdf.queryExecution().executedPlan().toString()
        assert len(found[-1]) == 4 and found[-1] == found[0]
        # Other columns than the months' bring rows together for the write once more.
        assert plan.count("Exchange") - plan.count("BroadcastExchange") == 1
        assert bool(calls[-1][1]["cluster_by"]) == (keys == ["origin"])


def test_large_groups_are_dealt_to_several_tasks_and_small_ones_share(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 900, 1).when(F.col("id") < 990, 2).otherwise(None).cast("int").alias("g"), "id")
    sizes = df.groupBy("g").count()
    out = dedupe_in_groups(df.union(df), F.col("g"), sizes, most=300)
    parts = out.withColumn("part", F.spark_partition_id()).groupBy("g", "part").count().collect()
    assert out.count() == 1000 and rows(out) == rows(df)
    assert {(r.g, r.part) for r in parts} == {(1, 0), (1, 1), (1, 2), (2, 3), (None, 3)}
    assert dedupe_in_groups(df.limit(0), F.col("g"), sizes.limit(0)).count() == 0


def test_no_python_in_the_plans(spark, tmp_path):
    write_cases(tmp_path, [RECORD])
    write_flights(tmp_path, [flight_line()])
    from dailyfacts.sources import read_case_documents, read_flight_files

    for df in (
        cases.model_cases(read_case_documents(spark, f"{tmp_path}/{cases.INPUT}")),
        flights.model_flights(read_flight_files(spark, f"{tmp_path}/{flights.INPUT}")),
    ):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan
        # One shuffle, with a partial aggregate before it.
        assert plan.count("Exchange") == 1 and plan.count("HashAggregate") == 2
