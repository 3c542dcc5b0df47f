"""Fact to fact by day, fact to lookup by code."""

from __future__ import annotations

from pyspark.sql import functions as F

from dailyfacts.catalogue.raw import lookup_rows
from dailyfacts.catalogue.registry import query, table
from dailyfacts.functions import flag_to_int
from dailyfacts.operators.joins import with_description
from dailyfacts.plans.daily import daily_impact


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
def daily_fact_join(spark, sf_dir):
    """Cases of one country next to the departures of every origin, newest day first."""
    cases = table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").cast("date").alias("daterep"),
        F.col("o_orderstatus").alias("country"),
        flag_to_int(F.col("o_totalprice")).alias("cases"),
        (F.col("o_custkey") % 100000).cast("int").alias("deaths"),
    )
    flights = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("origin"), F.col("l_shipdate").cast("date").alias("fl_date")
    )
    return daily_impact(cases, flights, "F")


@query("""
select l_orderkey, l_linenumber, l_partkey, l_suppkey,
  p_name || ', "' || cast(p_partkey as string) || '"' as part,
  s_name || ', "' || cast(s_suppkey as string) || '"' as supplier
from lineitem
left join part on l_partkey = p_partkey
left join supplier on l_suppkey = s_suppkey
""")
def fact_dimension_lookup(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"
    )
    parts = lookup_rows(table(spark, sf_dir, "part"), "p_partkey", "p_name")
    suppliers = lookup_rows(table(spark, sf_dir, "supplier"), "s_suppkey", "s_name")
    described = with_description(lineitem, parts, "l_partkey", name="part")
    return with_description(described, suppliers, "l_suppkey", name="supplier")
