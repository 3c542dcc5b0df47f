"""Months that changed, rejected fields, keyed lookups, stored buckets, sizes."""

import datetime as dt
import gzip
import os
from pathlib import Path
from types import SimpleNamespace

import pytest
from helpers import HEADER, conf, flight_line, write_flights
from pyspark.sql import DataFrameReader, DataFrameWriter

from dailyfacts.operators.digests import changed_months
from dailyfacts.operators.joins import RepeatedCode, as_keys, with_description
from dailyfacts.operators.writes import write_by_month
from dailyfacts.plans import flights
from dailyfacts.plans.daily import COUNTRY, daily_impact, daily_impact_by_day, store_by_day
from dailyfacts.plans.describe import describe_flights
from dailyfacts.schemas import FLIGHTS
from dailyfacts.session import scratch_path, sized_for
from dailyfacts.sources import read_flight_files, read_model
from dailyfacts.sources.files import SurplusColumn, check_surplus_columns, file_paths, read_flight_days

D1, D2 = dt.date(2020, 1, 1), dt.date(2020, 1, 2)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def month_rows(spark, values):
    return spark.createDataFrame(values, "k string, x double, _year int, _month int")


def files_of(path):
    """Names and times of the data files of each month."""
    return {
        str(p.relative_to(path)): os.stat(p).st_mtime_ns for p in Path(path).rglob("*.parquet") if "_digests" not in str(p)
    }


def test_only_changed_months_are_written(spark, tmp_path):
    path = str(tmp_path / "m")
    first = [("a", 1.0, 2020, 1), ("a", 1.0, 2020, 1), ("b", None, 2020, 2), (None, 2.0, None, None), ("c", 3.0, 2020, 3)]
    assert write_by_month(month_rows(spark, first), path, replace="changed") == 4
    before = files_of(path)
    assert write_by_month(month_rows(spark, first[::-1]), path, replace="changed") == 0
    assert files_of(path) == before
    # A row less, a null for a value, a row in a new month; one month is not in the input.
    second = [first[0], ("b", 0.0, 2020, 2), first[3], ("d", 4.0, 2020, 4)]
    assert write_by_month(month_rows(spark, second), path, replace="changed") == 3
    after = files_of(path)
    same = {f for f in before if "_month=3" in f or "DEFAULT" in f}
    assert {f for f in before if after.get(f) == before[f]} == same
    assert rows(spark.read.parquet(path)) == sorted(second + [first[4]], key=repr)


def test_changed_months_without_a_shuffle_are_written_once_and_moved(spark, tmp_path, monkeypatch):
    placed, shuffled, written = str(tmp_path / "m"), str(tmp_path / "s"), []
    parquet = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, *a, **k: written.append(path) or parquet(self, path, *a, **k))
    first = [("a", 1.0, 2020, 1), ("a", 1.0, 2020, 1), ("b", None, 2020, 2), (None, 2.0, None, None), ("c", 3.0, 2020, 3)]
    second = [first[0], ("b", 0.0, 2020, 2), ("n", 2.0, None, None), ("d", 4.0, 2020, 4), ("e", 5.0, None, 4)]
    for values, changed in ((first, 4), (first[::-1], 0), (second, 5), (second, 0), ([], 0)):
        before = files_of(placed)
        written.clear()
        assert write_by_month(month_rows(spark, values), placed, replace="changed", cluster_by=()) == changed
        # The rows go to disk once, and digests beside them; nothing is written to the dataset itself.
        assert len([p for p in written if "digests" not in p]) == 1 and placed not in written
        assert write_by_month(month_rows(spark, values), shuffled, replace="changed") == changed
        assert rows(spark.read.parquet(placed)) == rows(spark.read.parquet(shuffled))
        after = files_of(placed)
        kept = {f for f in before if after.get(f) == before[f]}
        assert kept == (set(before) if not changed else {f for f in before if changed == 5 and "_month=3" in f})
        assert {p.name for p in tmp_path.iterdir()} == {"m", "s"} and (tmp_path / "m/_SUCCESS").exists()
    none = str(tmp_path / "none")
    assert write_by_month(month_rows(spark, []), none, replace="changed", cluster_by=()) == 0
    assert not Path(none).exists()


def test_moved_months_are_seen_by_cached_reads(spark, tmp_path):
    path = str(tmp_path / "m")
    write_by_month(month_rows(spark, [("a", 1.0, 2020, 1)]), path, replace="changed", cluster_by=())
    seen = spark.read.parquet(path).cache()
    assert rows(seen) == [("a", 1.0, 2020, 1)]
    write_by_month(month_rows(spark, [("b", 1.0, 2020, 1)]), path, replace="changed", cluster_by=())
    assert rows(spark.read.parquet(path)) == [("b", 1.0, 2020, 1)]
    seen.unpersist()


def test_digests_do_not_hold_for_other_files(spark, tmp_path):
    path = str(tmp_path / "m")
    first, other = [("a", 1.0, 2020, 1), ("b", 2.0, 2020, 2)], [("z", 9.0, 2020, 2)]
    write_by_month(month_rows(spark, first), path, replace="changed")
    write_by_month(month_rows(spark, other), path, replace="months")
    assert write_by_month(month_rows(spark, first), path, replace="changed") == 1
    assert rows(spark.read.parquet(path)) == first
    write_by_month(month_rows(spark, other), path)
    assert write_by_month(month_rows(spark, first), path, replace="changed") == 2
    assert rows(spark.read.parquet(path)) == first


def test_a_run_that_stopped_before_its_digests_is_repeated(spark, tmp_path):
    path = str(tmp_path / "m")
    write_by_month(month_rows(spark, [("a", 1.0, 2020, 1)]), path, replace="changed")
    new, months = changed_months(month_rows(spark, [("b", 1.0, 2020, 1)]), path)
    write_by_month(new, path, replace="months")
    assert months.count() == 1
    assert write_by_month(month_rows(spark, [("b", 1.0, 2020, 1)]), path, replace="changed") == 1
    assert write_by_month(month_rows(spark, [("b", 1.0, 2020, 1)]), path, replace="changed") == 0


def test_flight_job_reports_changed_months_and_rejects(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path)
    lines = [flight_line(), flight_line(FL_DATE="2020-02-29"), flight_line(FL_DATE="2020-13-45", DEP_DELAY="late")]
    write_flights(source, [*lines, "2020-03-02,AA"])
    report = flights.load_flights(spark, str(source), out, replace="changed")
    assert report.months == 3 and report.rows_read == 4
    assert {k: v for k, v in report.rejects.items() if v} == {"fl_date": 1, "dep_delay": 1}
    write_flights(source, [flight_line(), flight_line(FL_DATE="2020-02-29", TAIL_NUM="X"), lines[2], "2020-03-02,AA"])
    assert flights.load_flights(spark, str(source), out, replace="changed").months == 1
    model = read_model(spark, f"{out}/{flights.OUTPUT}", FLIGHTS)
    assert rows(model.select("month", "tail_num")) == [(2, "X"), (3, "N1"), (3, None), (None, "N1")]
    assert flights.load_flights(spark, str(source), out).months is None


def test_rejected_fields_by_column(spark, tmp_path):
    lines = [flight_line(), flight_line(ORIGIN_AIRPORT_ID="x"), flight_line(ORIGIN_AIRPORT_ID="y, z", CANCELLED=""),
             flight_line(ARR_DELAY="?", FL_DATE="")]
    path = write_flights(tmp_path, [line + "," for line in lines], header=[*HEADER, ""])
    found = flights.rejected_fields(read_flight_files(spark, path, raw_line=True))
    counts = {r.column: r.rejected for r in found.collect()}
    assert {k: v for k, v in counts.items() if v} == {"origin_airport_id": 2, "arr_delay": 1}
    assert "tail_num" not in counts and len(counts) == 14


@pytest.mark.parametrize("more", [["EXTRA"], ["", ""], ["", "EXTRA"]])
def test_further_columns_fail_in_any_file(spark, tmp_path, more):
    write_flights(tmp_path, [flight_line()], "flights_2020_01.csv")
    tail = "," + ",".join("v" for _ in more)
    write_flights(tmp_path, [flight_line() + tail], "flights_2020_02.csv", header=[*HEADER, *more])
    path = f"{tmp_path}/{flights.INPUT}"
    with pytest.raises(SurplusColumn, match="flights_2020_02.csv"):
        read_flight_files(spark, path)
    assert read_flight_files(spark, path, check_header=False).count() == 2
    assert len(file_paths(spark, path)) == 2


def test_headers_are_checked_without_a_job_for_each_file(spark, tmp_path, monkeypatch):
    parsed, csv = [], DataFrameReader.csv
    monkeypatch.setattr(DataFrameReader, "csv", lambda self, path, *a, **k: parsed.append(path) or csv(self, path, *a, **k))
    for i in range(6):
        write_flights(tmp_path, [flight_line()], f"flights_2020_{i}.csv")
    packed = tmp_path / "flights/flights_0_0.csv"
    packed.mkdir()
    (packed / "part-0.csv.gz").write_bytes(gzip.compress((" \n" + ",".join(HEADER) + ",\n" + flight_line() + ",\n").encode()))
    path = f"{tmp_path}/{flights.INPUT}"
    check_surplus_columns(spark, path)
    # One file of each first line: the usual one, and the one with a column without a name.
    assert len(parsed) == 2
    (packed / "part-1.csv.gz").write_bytes(gzip.compress((",".join([*HEADER, "MORE"]) + "\n").encode()))
    with pytest.raises(SurplusColumn, match="part-1.csv.gz has columns that are not known: MORE"):
        check_surplus_columns(spark, path)


def test_days_are_cut_from_the_lines(spark, tmp_path):
    dates = ["2020-03-01", '"2020-03-02"', " 2020-04-01", "2020-13-45", "", "2020-5-6"]
    path = write_flights(tmp_path, [flight_line().replace("2020-03-01", d, 1) for d in dates])
    cut = [r[0] for r in read_flight_days(spark, path).collect()]
    assert cut == [None, *[r[0] for r in read_flight_files(spark, path).select("FL_DATE").collect()]]
    plan = read_flight_days(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "Scan text" in plan or "FileScan text" in plan
    found = {tuple(r) for r in flights.months_of(read_flight_days(spark, path)).collect()}
    assert found == {(2020 * 12 + 3, 2), (2020 * 12 + 4, 1), (2020 * 12 + 5, 1), (None, 3)}


def lookup(spark, *codes):
    return spark.createDataFrame([(c, f"is {c}") for c in codes], "code string, description string")


def test_codes_that_are_equal_after_the_cast_fail(spark):
    fact = spark.createDataFrame([(7, "07")], "n int, t string")
    spellings = lookup(spark, "7", "07", " 7", "x", None, None)
    with pytest.raises(RepeatedCode, match="lookup n has several rows for code 7"):
        with_description(fact, spellings, "n")
    # As texts they differ; null codes match nothing.
    assert rows(with_description(fact, spellings, "t")) == [(7, "07", "is 07")]
    with pytest.raises(RepeatedCode, match="several rows for code a"):
        as_keys({"l": (lookup(spark, "a", "a"), "string")})


def test_lookups_share_one_budget(spark):
    small, large = lookup(spark, "1"), lookup(spark, *[f"{i:09d}" for i in range(100, 200)])
    hinted = lambda df: "strategy=broadcast" in df._jdf.queryExecution().analyzed().toString()
    keyed = as_keys({"large": (large, "string"), "small": (small, "int"), "none": (lookup(spark, "x"), "int")}, 200)
    assert {name: hinted(df) for name, df in keyed.items()} == {"large": False, "small": True, "none": True}
    assert all(hinted(df) for df in as_keys({"large": (large, "string"), "small": (small, "int")}).values())
    assert as_keys({}) == {}


def test_a_lookup_of_two_columns_is_read_once(spark):
    fact = spark.createDataFrame([(1, 2, "A"), (2, 9, None)], "origin_airport_id int, dest_airport_id int, cancellation_code string")
    lookups = {"airport_id": lookup(spark, "1", "2"), "cancellation": lookup(spark, "A")}
    found = describe_flights(fact, lookups, ["origin_airport_id", "dest_airport_id", "cancellation_code"])
    assert rows(found) == [(1, 2, "A", "is 1", "is 2", "is A"), (2, 9, None, "is 2", None, None)]


def test_stored_buckets_join_without_a_shuffle(spark, tmp_path):
    database = "buckets_" + tmp_path.name.replace("-", "_")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{tmp_path}/db'")
    cases = spark.createDataFrame(
        [(D1, COUNTRY, 5, 1), (D1, COUNTRY, 5, 1), (D2, COUNTRY, 7, None), (D2, "Italy", 8, 2), (None, COUNTRY, 9, 9)],
        "daterep date, country string, cases int, deaths int",
    )
    departed = spark.createDataFrame([(D1, "JFK"), (D1, "JFK"), (D2, None), (D2, "LAX")], "fl_date date, origin string")
    for _ in range(2):
        store_by_day(spark, cases, departed, 4, database)
    expected = [tuple(r) for r in daily_impact(cases, departed).collect()]
    never = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    with conf(spark, never):
        answer = daily_impact_by_day(spark, COUNTRY, database)
        plan = answer._jdf.queryExecution().executedPlan().toString()
        # The one shuffle is that of the last sort.
        assert plan.count("Exchange") == 1 and "rangepartitioning" in plan and "SortMergeJoin" in plan
        assert [tuple(r) for r in answer.collect()] == expected
    assert [tuple(r) for r in daily_impact_by_day(spark, COUNTRY, database).collect()] == expected
    assert len(list(Path(f"{tmp_path}/db/departures_by_day").glob("*.parquet"))) <= 4
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_sizes_hold_for_a_block(spark, tmp_path):
    (tmp_path / "f.csv").write_bytes(b"x" * 1000)
    keys = ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes")
    before = {key: spark.conf.get(key) for key in keys}
    with pytest.raises(ZeroDivisionError), sized_for(spark, [str(tmp_path)], partition_bytes=100):
        assert spark.conf.get(keys[0]) == "10"
        raise ZeroDivisionError
    assert {key: spark.conf.get(key) for key in keys} == before
    assert keys[1] not in spark.conf.getAll


def test_shuffle_files_go_when_a_write_of_a_block_ends(spark, tmp_path):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        names = (files.apply(i).getName() for i in range(files.size()))
        return {name for name in names if name.startswith("shuffle_") and name.endswith(".data")}

    (tmp_path / "f.csv").write_bytes(b"x")
    with sized_for(spark, str(tmp_path)):
        before = shuffled()
        write_by_month(month_rows(spark, [("a", 1.0, 2020, 1), ("b", 2.0, 2020, 2)]).dropDuplicates(), str(tmp_path / "m"))
        assert not shuffled() - before
    assert spark.read.parquet(str(tmp_path / "m")).count() == 2


def test_changed_months_leave_no_scratch_files(spark, tmp_path):
    before = set(Path(scratch_path(spark, "x").removeprefix("file:")).parent.glob("dailyfacts-*"))
    for rows_now in ([("a", 1.0, 2020, 1)], [("a", 1.0, 2020, 1)], [("b", 1.0, 2020, 1)]):
        write_by_month(month_rows(spark, rows_now), str(tmp_path / "m"), replace="changed")
    assert set(Path(scratch_path(spark, "x").removeprefix("file:")).parent.glob("dailyfacts-*")) <= before


def test_jobs_are_sized_for_their_own_files(spark, tmp_path, monkeypatch):
    write_flights(tmp_path, [flight_line()])
    (tmp_path / "other.bin").write_bytes(b"x" * 10_000_000)
    sized = []
    monkeypatch.setattr(flights, "sized_for", lambda s, path: sized.append(path) or sized_for(s, path))
    flights.load_flights(spark, str(tmp_path), str(tmp_path / "out"))
    flights.load_flights(spark, str(tmp_path), str(tmp_path / "out"), sized=False)
    assert sized == [f"{tmp_path}/{flights.INPUT}"]


def test_scratch_refuses_a_drivers_own_disk():
    def session(master, **settings):
        unset = SimpleNamespace(isDefined=lambda: False)
        context = SimpleNamespace(getCheckpointDir=lambda: unset)
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda key, default=None: settings.get(key.split(".", 1)[1], default)),
            sparkContext=SimpleNamespace(master=master, _jsc=SimpleNamespace(sc=lambda: context)),
        )

    disk, shared = {"sql.warehouse.dir": "file:/home/w"}, {"sql.warehouse.dir": "hdfs://n/w"}
    assert scratch_path(session("local[4]", **disk), "x").startswith("file:/home/w/dailyfacts-x-")
    assert scratch_path(session("yarn", **shared), "x").startswith("hdfs://n/w/")
    assert scratch_path(session("yarn", **disk, **{"checkpoint.dir": "/shared"}), "x").startswith("/shared/")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(session("yarn", **disk), "x")
