"""Column expressions and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from dailyfacts.catalogue.registry import query, table
from dailyfacts.functions import flag_to_bool, flag_to_int, lenient_int, month_of, parse_day, year_of
from dailyfacts.operators.columns import lower_names
from dailyfacts.operators.filters import rows_with_null


@query("""
select o_orderkey, o_orderdate, cast(year(o_orderdate) as integer) as year,
  cast(month(o_orderdate) as integer) as month
from orders
""")
def date_parts(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    day = F.col("o_orderdate")
    return orders.withColumns({"year": year_of(day), "month": month_of(day)})


@query("""
select o_orderkey, cast(strptime(strftime(o_orderdate, '%d/%m/%Y'), '%d/%m/%Y') as date) as daterep
from orders
""")
def parse_dmy_date(spark, sf_dir):
    text = F.date_format(F.col("o_orderdate").cast("date"), "dd/MM/yyyy")
    return table(spark, sf_dir, "orders").select("o_orderkey", parse_day(text).alias("daterep"))


@query("""
select event_id, try_cast(regexp_extract(props, '[0-9]+') as integer) as k,
  cast(trunc(value) as integer) as whole,
  cast(null as integer) as none
from events
""")
def cast_text_to_int(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id",
        lenient_int(F.get_json_object("props", "$.k")).alias("k"),
        lenient_int(F.col("value").cast("decimal(18,2)").cast("string")).alias("whole"),
        lenient_int(F.col("event_type")).alias("none"),
    )


@query("""
select l_orderkey, l_linenumber, cast(trunc(l_quantity) as integer) as quantity,
  cast(trunc(l_tax * 100 + 0.5) as integer) as tax_cents
from lineitem
""")
def cast_float_to_int(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        flag_to_int(F.col("l_quantity")).alias("quantity"),
        flag_to_int(F.col("l_tax") * 100 + 0.5).alias("tax_cents"),
    )


_FLAGS = """
select l_orderkey, l_linenumber, case
  when l_linenumber = 1 then cast('NaN' as float) when l_linenumber = 2 then cast('Infinity' as float)
  when l_linenumber = 3 then cast(3e9 as float) when l_linenumber = 4 then cast(-0.5 as float)
  when l_linenumber = 5 then null else cast(l_quantity as float) end as flag
from lineitem
"""


@query(f"""
select l_orderkey, l_linenumber,
  case when l_linenumber <= 3 then null else cast(trunc(flag) as integer) end as whole, flag <> 0 as truth
from ({_FLAGS})
""")
def flag_edges(spark, sf_dir):
    """Flags that are no number, out of range, below one or null."""
    rows = spark.sql(_FLAGS.replace("lineitem", "{lineitem}"), lineitem=table(spark, sf_dir, "lineitem"))
    return rows.select(
        "l_orderkey", "l_linenumber", flag_to_int(F.col("flag")).alias("whole"), flag_to_bool(F.col("flag")).alias("truth")
    )


@query("""
select o_orderkey, case when o_custkey % 5 = 0 then null else cast(o_orderdate as date) end as daterep
from orders
""")
def parse_odd_dates(spark, sf_dir):
    """Dates with one digit for day and month, and texts that are no dates."""
    day = F.col("o_orderdate").cast("date")
    wrong = F.array(
        F.concat(F.lit("31/02/"), F.year(day)), F.date_format(day, "yyyy-MM-dd"), F.lit(""),
        F.date_format(day, "d/M/yy"), F.lit(None).cast("string"),
    )
    text = F.when(
        F.col("o_custkey") % 5 == 0, F.get(wrong, (F.col("o_orderkey") % 5).cast("int"))
    ).otherwise(F.date_format(day, "d/M/yyyy"))
    return table(spark, sf_dir, "orders").select("o_orderkey", parse_day(text).alias("daterep"))


@query("select l_orderkey, l_linenumber, cast(l_discount as boolean) as discounted from lineitem")
def cast_float_to_bool(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", flag_to_bool(F.col("l_discount")).alias("discounted")
    )


@query("select * from customer")
def lowercase_columns(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    return customer.toDF(*[name.upper() for name in customer.columns]).transform(lower_names)


@query("select o_orderkey, o_orderdate, o_totalprice from orders where o_orderstatus = 'F'")
def equality_filter(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F")
    return orders.select("o_orderkey", "o_orderdate", "o_totalprice")


@query("""
select o_orderkey, o_orderdate, nullif(o_orderstatus, 'F') as status
from orders where nullif(o_orderstatus, 'F') is null
""")
def rows_with_null_status(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderdate", F.nullif("o_orderstatus", F.lit("F")).alias("status")
    )
    return rows_with_null(orders, "status")
