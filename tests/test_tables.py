import datetime as dt
import glob
import uuid

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from dailyfacts.operators.quality import (
    QualityError,
    Rule,
    check_rules,
    expect_scalar,
    gate,
    null_rule,
    rule_counts,
)
from dailyfacts.operators.tables import (
    create_table,
    drop_table,
    load_table,
    require_columns,
    split_required,
)
from dailyfacts.schemas import CASES, FLIGHTS, LOOKUPS, TABLES
from dailyfacts.sources import read_table

DAY = dt.date(2020, 3, 1)


@pytest.fixture
def database(spark, tmp_path):
    name = f"db_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/db'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def cases(spark, *countries, day=DAY):
    rows = [(c, "America", "US", 1, 2, day, 1, 3, 2020) for c in countries]
    return spark.createDataFrame(rows, ", ".join(f"{n} {t}" for n, t in CASES.columns))


def flights(spark, n=1, **nulls):
    values = {
        "string": F.lit("x"), "int": F.lit(1), "float": F.lit(1.0).cast("float"), "date": F.lit(DAY)
    }
    return spark.range(n).select(
        *[nulls.get(name, values[kind]).cast(kind).alias(name) for name, kind in FLIGHTS.columns]
    )


def test_nine_tables_with_the_given_columns(spark, database):
    assert len(TABLES) == 9 and len(FLIGHTS.columns) == 33 and len(FLIGHTS.required) == 23
    for spec in TABLES.values():
        create_table(spark, spec, database)
        create_table(spark, spec, database)
        assert read_table(spark, spec, database).dtypes == list(spec.columns)
    assert spark.sql(f"SHOW TABLES IN {database}").count() == 9


def test_drop_removes_table_and_files(spark, database, tmp_path):
    create_table(spark, CASES, database)
    load_table(spark, CASES, cases(spark, "a"), database)
    assert glob.glob(f"{tmp_path}/db/covid/**/*.parquet", recursive=True)
    drop_table(spark, CASES, database)
    drop_table(spark, CASES, database)
    assert not glob.glob(f"{tmp_path}/db/covid")
    assert not spark.catalog.tableExists(f"{database}.covid")


def test_load_binds_by_name_and_appends(spark, database):
    create_table(spark, CASES, database)
    df = cases(spark, "a")
    load_table(spark, CASES, df.select(*reversed(df.columns)), database)
    load_table(spark, CASES, cases(spark, "b"), database)
    loaded = read_table(spark, CASES, database).orderBy("country").collect()
    assert [tuple(r) for r in loaded] == [
        (c, "America", "US", 1, 2, DAY, 1, 3, 2020) for c in ("a", "b")
    ]


def test_files_are_sorted_by_the_sort_key(spark, database, tmp_path):
    create_table(spark, CASES, database)
    names = [f"c{i:03d}" for i in range(200)]
    df = cases(spark, *reversed(names)).withColumn("month", (F.rand(1) * 3 + 1).cast("int"))
    load_table(spark, CASES, df.coalesce(1), database)
    files = glob.glob(f"{tmp_path}/db/covid/month=*/year=2020/*.parquet")
    assert len(files) == 3
    for file in files:
        countries = pq.ParquetFile(file).read().column("country").to_pylist()
        assert len(countries) > 10 and countries == sorted(countries)


@pytest.mark.parametrize("column", ["fl_date", "cancelled", "month"])
def test_null_in_a_required_column_fails_the_load(spark, database, column):
    create_table(spark, FLIGHTS, database)
    load_table(spark, FLIGHTS, flights(spark), database)
    bad = flights(spark, 50, **{column: F.when(F.col("id") != 33, F.lit(DAY if column == "fl_date" else 1))})
    with pytest.raises(Exception, match=f"flights.{column} is null"):
        load_table(spark, FLIGHTS, bad, database)
    assert read_table(spark, FLIGHTS, database).count() == 1


def test_optional_columns_may_be_null(spark, database):
    create_table(spark, FLIGHTS, database)
    load_table(spark, FLIGHTS, flights(spark, tail_num=F.lit(None), arr_del15=F.lit(None)), database)
    assert read_table(spark, FLIGHTS, database).first().tail_num is None
    lookup = LOOKUPS["state_fips"]
    assert require_columns(spark.range(1), lookup).count() == 1


def test_split_required(spark):
    df = flights(spark, 3, origin=F.when(F.col("id") > 0, F.lit("x")), dest=F.when(F.col("id") > 1, F.lit("x")))
    good, bad = split_required(df, FLIGHTS)
    assert good.count() == 1
    assert sorted(bad.select("missing").collect()) == [(["dest"],), (["origin", "dest"],)]


def test_rules_count_in_one_pass(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, 4), (5, 6)], "a int, b int")
    rules = [null_rule(["a", "b"]), null_rule(["a"]), Rule("large", F.col("a") > 2, expected=2)]
    assert [(r.actual, r.passed) for r in check_rules(df, rules)] == [(2, False), (1, False), (2, True)]
    assert [tuple(r) for r in rule_counts(df, rules).collect()] == [
        ("a is null or b is null", 2), ("a is null", 1), ("large", 2)
    ]
    assert [r.actual for r in check_rules(df.where("false"), rules)] == [0, 0, 0]


def test_null_rules_reach_the_scan(spark, tmp_path):
    cases(spark, "a", "b").write.parquet(str(tmp_path / "c"))
    df = spark.read.parquet(str(tmp_path / "c"))
    plan = rule_counts(df, [null_rule(CASES.gate)])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(IsNull(country),IsNull(daterep))]" in plan
    assert "ReadSchema: struct<country:string,daterep:date>" in plan


def test_gate(spark):
    assert all(r.passed for r in gate(cases(spark, "a"), CASES))
    with pytest.raises(QualityError, match="covid: country is null or daterep is null: 2 not matching 0"):
        gate(cases(spark, "a", None).union(cases(spark, "b", day=None)), CASES)


def test_scalar_expectation(spark):
    df = cases(spark, "a", "b")
    statement = "select count(*) from {t} where country is null"
    assert expect_scalar(spark, statement, 0, t=df) == 0
    with pytest.raises(ValueError, match="2 not matching 0"):
        expect_scalar(spark, "select count(*) from {t}", 0, t=df)
    with pytest.raises(QualityError, match="no row"):
        expect_scalar(spark, "select 1 from {t} where country = 'z'", 1, t=df)
