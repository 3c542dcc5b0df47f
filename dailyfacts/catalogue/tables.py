"""Catalog tables and quality rules."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from dailyfacts.catalogue.registry import query, table
from dailyfacts.operators.quality import (
    QualityError,
    Rule,
    check_rules,
    enforce,
    expect_scalar,
    gate,
    null_rule,
    rule_counts,
)
from dailyfacts.operators.publish import publish_after, shown_table
from dailyfacts.operators.tables import (
    create_table,
    drop_table,
    load_good_rows,
    load_table,
    read_range,
    split_required,
)
from dailyfacts.schemas import TableSpec
from dailyfacts.session import scratch_path
from dailyfacts.sources import read_table

# Orders as a table with required columns, partitions and a sort key.
ORDERS = TableSpec(
    "orders_fact",
    (
        ("o_orderkey", "bigint"),
        ("o_custkey", "bigint"),
        ("o_orderstatus", "string"),
        ("o_totalprice", "double"),
        ("o_orderdate", "date"),
        ("o_orderpriority", "string"),
        ("month", "int"),
        ("year", "int"),
    ),
    partition_by=("month", "year"),
    sort_by=("year", "month", "o_orderpriority"),
    required=("o_orderkey", "o_orderstatus", "o_orderdate", "year", "month"),
    gate=("o_orderkey", "o_orderdate"),
)

_ORDERS_SQL = """
select o_orderkey, o_custkey, o_orderstatus, o_totalprice, cast(o_orderdate as date) as o_orderdate,
  o_orderpriority, cast(month(o_orderdate) as integer) as month,
  cast(year(o_orderdate) as integer) as year
from orders
"""


def scratch_database(spark) -> str:
    """A new database whose tables live in the scratch folder."""
    name = f"dailyfacts_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, 'db')}'")
    return name


def _orders(spark, sf_dir):
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").withColumns(
        {"o_orderdate": day, "year": F.year(day), "month": F.month(day)}
    )


def _orders_with_nulls(spark, sf_dir):
    """Orders without the status of finished ones and without low priorities."""
    return _orders(spark, sf_dir).withColumns(
        {
            "o_orderstatus": F.nullif("o_orderstatus", F.lit("F")),
            "o_orderpriority": F.nullif("o_orderpriority", F.lit("5-LOW")),
        }
    )


def _reload(spark, sf_dir):
    database = scratch_database(spark)
    for _ in range(2):
        drop_table(spark, ORDERS, database)
        create_table(spark, ORDERS, database)
    load_table(spark, ORDERS, _orders(spark, sf_dir), database)
    return read_table(spark, ORDERS, database)


@query(_ORDERS_SQL)
def table_reload(spark, sf_dir):
    """Drop, create, load by name, scan."""
    return _reload(spark, sf_dir)


@query(f"select * from ({_ORDERS_SQL})")
def quality_gate(spark, sf_dir):
    """A loaded table that is handed on only when its gate columns hold no null."""
    orders = _reload(spark, sf_dir)
    gate(orders, ORDERS)
    return orders


@query("""
select 'o_orderstatus is null or o_orderpriority is null' as rule, count(*) as bad_rows
from orders where o_orderstatus = 'F' or o_orderpriority = '5-LOW'
union all
select 'o_orderkey is null', count(*) from orders where o_orderkey is null
union all
select 'no price', count(*) from orders where o_totalprice <= 0
""")
def null_rule_count(spark, sf_dir):
    """Several rules of one table in one pass."""
    rules = [
        null_rule(["o_orderstatus", "o_orderpriority"]),
        null_rule(["o_orderkey"]),
        Rule("no price", F.col("o_totalprice") <= 0),
    ]
    return rule_counts(_orders_with_nulls(spark, sf_dir), rules)


@query("""
select o_orderkey, 'o_orderstatus' as missing from orders where o_orderstatus = 'F'
""")
def required_columns(spark, sf_dir):
    """Rows that miss a required column, with the columns they miss."""
    _, bad = split_required(_orders_with_nulls(spark, sf_dir), ORDERS)
    return bad.select("o_orderkey", F.array_join("missing", ",").alias("missing"))


@query("select count(*) as n, count(distinct o_orderkey) as keys from orders")
def scalar_expectation(spark, sf_dir):
    """Counts that are handed on only when a scalar statement has the expected value."""
    orders = table(spark, sf_dir, "orders")
    expect_scalar(
        spark,
        "select count(*) from {orders} where o_orderkey is null or o_orderdate is null",
        0,
        orders=orders,
    )
    rules = [null_rule(["o_orderkey"]), null_rule(["o_custkey"])]
    enforce("orders", check_rules(orders, rules))
    return orders.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("o_orderkey").alias("keys"))


@query(f"select * from ({_ORDERS_SQL}) where o_orderpriority between '2-HIGH' and '3-MEDIUM'")
def sorted_table_load(spark, sf_dir):
    """A range of the sort key, read from the files that may hold it."""
    database = scratch_database(spark)
    create_table(spark, ORDERS, database)
    load_table(spark, ORDERS, _orders(spark, sf_dir), database)
    return read_range(spark, ORDERS, "o_orderpriority", "2-HIGH", "3-MEDIUM", database)


@query(f"""
select * replace (case when year >= 2000 then 'R' else o_orderstatus end as o_orderstatus) from ({_ORDERS_SQL})
""")
def staged_reload(spark, sf_dir):
    """Three loads: a good one, one that the gate stops and nobody sees, one with changed rows."""
    database = scratch_database(spark)
    orders = _orders(spark, sf_dir)

    def publish(rows):
        def fill(into):
            rules = [null_rule(ORDERS.gate), null_rule(["o_orderpriority"])]
            enforce(ORDERS.name, load_table(spark, into(ORDERS), rows, database, rules))

        return publish_after(spark, [ORDERS], fill, database)

    first = publish(orders)
    try:
        publish(orders.withColumn("o_orderpriority", F.nullif("o_orderpriority", F.lit("5-LOW"))))
    except QualityError:
        pass
    if not shown_table(spark, ORDERS, database).name.endswith(first):
        raise QualityError("a load that failed its gate is shown")
    changed = F.when(F.col("year") >= 2000, "R").otherwise(F.col("o_orderstatus"))
    publish(orders.withColumn("o_orderstatus", changed))
    return read_table(spark, ORDERS, database)


@query("""
select 'o_orderstatus is null or o_orderpriority is null' as rule, count(*) as bad_rows
from orders where o_orderstatus = 'F' or o_orderpriority = '5-LOW'
union all
select 'o_orderkey is null', count(*) from orders where o_orderkey is null
union all
select 'dear', count(*) from orders where o_totalprice > 100000
""")
def observed_gate(spark, sf_dir):
    """Rules counted while a table is loaded, without a scan of the table."""
    database = scratch_database(spark)
    spec = replace(ORDERS, required=(), sort_by=())
    create_table(spark, spec, database)
    rules = [
        null_rule(["o_orderstatus", "o_orderpriority"]),
        null_rule(["o_orderkey"]),
        Rule("dear", F.col("o_totalprice") > 100_000),
    ]
    results = load_table(spark, spec, _orders_with_nulls(spark, sf_dir), database, rules)
    return spark.createDataFrame([(r.rule, r.actual) for r in results], "rule string, bad_rows long")


@query(f"""
select * replace (nullif(o_orderstatus, 'F') as o_orderstatus, nullif(o_orderpriority, '5-LOW') as o_orderpriority),
  case when o_orderstatus = 'F' then 'o_orderstatus' end as missing
from ({_ORDERS_SQL})
""")
def load_with_rejects(spark, sf_dir):
    """Good rows in a table, rows without a required column beside it, from one computation."""
    database, rejects = scratch_database(spark), scratch_path(spark, "rejects")
    create_table(spark, ORDERS, database)
    load_good_rows(spark, ORDERS, _orders_with_nulls(spark, sf_dir), rejects, database)
    loaded = read_table(spark, ORDERS, database).withColumn("missing", F.lit(None).cast("string"))
    beside = spark.read.parquet(rejects).withColumn("missing", F.array_join("missing", ","))
    return loaded.unionByName(beside)
