import datetime as dt

from helpers import conf, executed_plan
from pyspark.sql import functions as F

from dailyfacts.operators.joins import (
    broadcast_if_small,
    join_on_day,
    only_months_of,
    value_bytes,
    with_description,
)
from dailyfacts.operators.writes import write_by_month
from dailyfacts.operators.columns import add_month_partitions
from dailyfacts.plans.daily import COUNTRY, daily_impact

D1, D2, D3 = dt.date(2020, 1, 1), dt.date(2020, 1, 2), dt.date(2020, 2, 1)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_join_on_day_is_inner_and_skips_null_days(spark):
    left = spark.createDataFrame([(D1, 1), (D2, 2), (None, 3)], "day date, n int")
    right = spark.createDataFrame([(D1, "a"), (D1, "b"), (D3, "c"), (None, "d")], "fl_date date, o string")
    assert rows(join_on_day(left, right, "day", "fl_date")) == [(D1, 1, D1, "a"), (D1, 1, D1, "b")]


def test_hot_day_is_split(spark):
    """A day with most of the rows does not become one task of the sort-merge join."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
        "spark.sql.shuffle.partitions": "8",
    }
    with conf(spark, small):
        day = F.when(F.col("id") % 3 > 0, F.lit(D1)).otherwise(
            F.date_add(F.lit(D2), (F.col("id") % 97).cast("int"))
        )
        cases = spark.range(0, 60_000, 1, 8).select(
            day.alias("daterep"),
            F.lit(COUNTRY).alias("country"),
            F.col("id").alias("cases"),
            F.sha2(F.col("id").cast("string"), 256).alias("deaths"),
        )
        flights = cases.select(F.col("daterep").alias("fl_date"), F.lit("JFK").alias("origin"))
        joined = daily_impact(cases, flights)
        assert "SortMergeJoin(skew=true)" in executed_plan(joined)
        assert joined.count() == 60_000


def test_descriptions_by_both_ways(spark):
    fact = spark.createDataFrame([(1,), (7,), (9,), (None,)], "airport int")
    codes = [("1", "one"), ("07", "seven"), ("x", "text"), (None, "nothing")]
    lookup = spark.createDataFrame(codes, "code string, description string")
    expected = [(1, "one"), (7, "seven"), (9, None), (None, None)]
    small = with_description(fact, lookup, "airport")
    assert small.columns == ["airport", "airport_description"]
    assert rows(small) == expected
    large = with_description(fact, lookup, "airport", limit=0)
    assert rows(large) == expected
    codes = spark.createDataFrame([("A",), ("B",)], "cancellation_code string")
    names = spark.createDataFrame([("A", "Carrier")], "code string, description string")
    assert rows(with_description(codes, names, "cancellation_code")) == [("A", "Carrier"), ("B", None)]


def test_a_large_lookup_is_hashed_where_it_is_shuffled(spark):
    fact = spark.range(50).selectExpr("cast(id % 7 as int) as airport")
    lookup = spark.range(30).selectExpr("cast(id as string) as code", "concat('d', id) as description")
    large = with_description(fact, lookup, "airport", limit=1000)
    plan = executed_plan(large)
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    assert rows(large) == sorted((i % 7, f"d{i % 7}") for i in range(50))
    # Parts that may not fit are left to the planner.
    assert "shuffle_hash" not in with_description(fact, lookup, "airport", limit=0)._jdf.queryExecution().analyzed().toString()


def test_broadcast_is_measured(spark):
    lookup = spark.createDataFrame([("1", "four"), (None, None)], "code string, description string")
    assert value_bytes(lookup) == 5 + 2 * 32
    assert value_bytes(lookup.where("false")) == 0
    hinted = lambda df: "strategy=broadcast" in df._jdf.queryExecution().analyzed().toString()
    assert hinted(broadcast_if_small(lookup, 69))
    assert not hinted(broadcast_if_small(lookup, 68))


def _facts(spark):
    cases = spark.createDataFrame(
        [
            (D1, COUNTRY, 5, 1),
            (D1, COUNTRY, 5, 1),
            (D1, COUNTRY, 6, 1),
            (D2, COUNTRY, 7, None),
            (D3, "Italy", 8, 2),
            (None, COUNTRY, 9, 9),
        ],
        "daterep date, country string, cases int, deaths int",
    )
    flights = spark.createDataFrame(
        [(D1, "JFK"), (D1, "JFK"), (D1, None), (D2, "LAX"), (D3, "JFK"), (None, "SFO")], "fl_date date, origin string"
    ).withColumns({"year": F.year("fl_date"), "month": F.month("fl_date")})
    return cases, flights


EXPECTED = [
    (D2, COUNTRY, 7, None, "LAX", D2, 1),
    (D1, COUNTRY, 5, 1, None, D1, 0),
    (D1, COUNTRY, 6, 1, None, D1, 0),
    (D1, COUNTRY, 5, 1, "JFK", D1, 2),
    (D1, COUNTRY, 6, 1, "JFK", D1, 2),
]


def test_daily_impact(spark):
    cases, flights = _facts(spark)
    plain = daily_impact(cases, flights)
    assert plain.columns == ["daterep", "country", "cases", "deaths", "origin", "fl_date", "num"]
    assert [tuple(r) for r in plain.collect()] == EXPECTED
    assert [tuple(r) for r in daily_impact(cases, flights, month=("year", "month")).collect()] == EXPECTED


def test_daily_impact_equals_the_sql(spark):
    cases, flights = _facts(spark)
    sql = f"""
        with days as (select daterep, country, cases, deaths from {{cases}} where country = '{COUNTRY}'
                      group by daterep, country, cases, deaths),
        counts as (select origin, fl_date, count(origin) as num from {{flights}} group by origin, fl_date)
        select * from days join counts on daterep = fl_date order by daterep desc"""
    assert rows(spark.sql(sql, cases=cases, flights=flights)) == rows(daily_impact(cases, flights))


def test_other_months_are_not_read(spark, tmp_path):
    cases, flights = _facts(spark)
    write_by_month(flights.transform(add_month_partitions), str(tmp_path / "f"))
    stored = spark.read.parquet(str(tmp_path / "f"))
    days = cases.where(F.col("country") == COUNTRY)
    kept = only_months_of(stored, "_year", "_month", days, "daterep")
    plan = executed_plan(kept)
    assert "dynamicpruningexpression(_year" in plan and "BroadcastHashJoin" in plan
    assert {r.fl_date for r in kept.collect()} == {D1, D2}
