"""Distinct rows, counts, profiles, top days."""

from __future__ import annotations

from pyspark.sql import functions as F

from dailyfacts.catalogue.registry import query, table
from dailyfacts.operators.aggregates import (
    count_where,
    dedupe,
    distinct_rows,
    first_rows,
    grouped_count,
    non_null_counts,
    null_counts,
    null_profile,
    repeated_keys,
)
from dailyfacts.operators.filters import any_null
from dailyfacts.operators.layout import shared
from dailyfacts.session import scratch_path

# Events with nulls: errors lose their type, values below 1 are unknown.
_EVENTS_SQL = """
select event_id, ts, user_id, nullif(event_type, 'error') as event_type,
  case when value >= 1 then value end as value, props
from events
"""


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        "user_id",
        F.nullif("event_type", F.lit("error")).alias("event_type"),
        F.when(F.col("value") >= 1, F.col("value")).alias("value"),
        "props",
    )


_EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


@query("select o_orderstatus, o_orderpriority from orders group by o_orderstatus, o_orderpriority")
def distinct_by_group(spark, sf_dir):
    return distinct_rows(table(spark, sf_dir, "orders"), "o_orderstatus", "o_orderpriority")


@query("""
select nullif(l_returnflag, 'N') as origin, cast(l_shipdate as date) as fl_date,
  count(nullif(l_returnflag, 'N')) as num
from lineitem group by 1, 2
""")
def grouped_count_col(spark, sf_dir):
    flights = table(spark, sf_dir, "lineitem").select(
        F.nullif("l_returnflag", F.lit("N")).alias("origin"),
        F.col("l_shipdate").cast("date").alias("fl_date"),
    )
    return grouped_count(flights, ["origin", "fl_date"], "origin")


@query(f"select count(*) as n from ({_EVENTS_SQL}) where event_type is null or value is null")
def count_where_null(spark, sf_dir):
    return count_where(_events(spark, sf_dir), any_null(["event_type", "value"]))


@query(f"select {', '.join(f'count({c}) as {c}' for c in _EVENT_COLUMNS)} from ({_EVENTS_SQL})")
def non_null_profile(spark, sf_dir):
    return non_null_counts(_events(spark, sf_dir))


@query(
    f"select {', '.join(f'count(*) - count({c}) as {c}' for c in _EVENT_COLUMNS)}"
    f" from ({_EVENTS_SQL})"
)
def null_count_profile(spark, sf_dir):
    return null_counts(_events(spark, sf_dir))


def _profile_sql(columns, source):
    return " union all ".join(
        f"select '{c}' as \"column\", count({c}) as non_null, count(*) - count({c}) as nulls"
        f" from ({source})"
        for c in columns
    )


@query(_profile_sql(_EVENT_COLUMNS, _EVENTS_SQL))
def column_profile(spark, sf_dir):
    return null_profile(_events(spark, sf_dir))


@query("select * from orders")
def dedupe_full_row(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return dedupe(orders.union(orders))


@query("""
select cast(o_orderdate as date) as daterep, o_orderpriority as country, count(*) as variants
from (select distinct o_orderdate, o_orderpriority, o_totalprice, o_custkey from orders)
group by 1, 2 having count(*) > 1
""")
def repeated_days(spark, sf_dir):
    """Days of a country that were reported with different counts."""
    cases = table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").cast("date").alias("daterep"),
        F.col("o_orderpriority").alias("country"),
        F.col("o_totalprice").alias("cases"),
        F.col("o_custkey").alias("deaths"),
    )
    return repeated_keys(cases, ["daterep", "country"], ["cases", "deaths"])


@query("""
select l_shipdate, count(*) as num from lineitem
group by l_shipdate order by num desc, l_shipdate desc limit 10
""")
def top_days(spark, sf_dir):
    days = table(spark, sf_dir, "lineitem").groupBy("l_shipdate").agg(F.count(F.lit(1)).alias("num"))
    return first_rows(days, 10, F.col("num").desc(), F.col("l_shipdate").desc())


@query(f"""
select event_type, count(*) as n, (select count(*) from ({_EVENTS_SQL}) where value is null) as unknown
from ({_EVENTS_SQL}) group by event_type
""")
def shared_scan(spark, sf_dir):
    """Two questions to one persisted intermediate result."""
    stored = scratch_path(spark, "types")
    with shared(_events(spark, sf_dir).select("event_type", "value")) as events:
        unknown = events.where("value is null").count()
        types = events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
        types.withColumn("unknown", F.lit(unknown).cast("bigint")).write.parquet(stored)
    return spark.read.parquet(stored)
