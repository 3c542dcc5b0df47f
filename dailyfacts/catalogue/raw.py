"""Raw input files made from the benchmark tables.

Orders become case records, line items become flight rows, the small tables become
lookups. Everything is written by Spark, row for row, so the files grow with the tables. Files
that one task reads whole are compressed, and have a bounded number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from threading import Lock

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dailyfacts.catalogue.registry import table
from dailyfacts.plans import cases, flights
from dailyfacts.schemas import FLIGHT_FILE_COLUMNS, LOOKUP_FILES
from dailyfacts.session import input_bytes, scratch_path

#: Lines in a compressed file, which is read by one task: some 40 MB of flight rows.
LINES = 250_000

# Values of the 31 flight columns, in file order. The text is valid in both SQL dialects.
FLIGHT_VALUES = dict(zip([name for name, _ in FLIGHT_FILE_COLUMNS], [
    "cast(l_shipdate as date)",
    "l_returnflag",
    "case when l_linenumber < 7 then concat('N', cast(l_suppkey as string)) end",
    "cast(l_partkey % 1000000 as int)",
    "cast(l_suppkey % 1000000 as int)",
    "l_linenumber",
    "concat(l_returnflag, l_linestatus)",
    "concat('City \"', l_linestatus, '\", ', l_returnflag)",
    "l_linestatus",
    "lpad(cast(l_linenumber as string), 2, '0')",
    "concat('State ', l_linestatus)",
    "cast(l_linenumber + 10 as string)",
    "cast(l_orderkey % 1000000 as int)",
    "cast(l_suppkey % 1000 as int)",
    "l_linenumber + 1",
    "l_linestatus",
    "concat('To ', l_linestatus, ', ', l_returnflag)",
    "l_returnflag",
    "lpad(cast(l_linenumber as string), 3, '0')",
    "concat('State ', l_returnflag)",
    "cast(l_linenumber + 20 as string)",
    "lpad(cast(cast(l_quantity as int) * 10 as string), 4, '0')",
    "cast(l_quantity - 10 as float)",
    "cast(greatest(l_quantity - 10, 0) as float)",
    "cast(case when l_quantity >= 25 then 1 else 0 end as float)",
    "case when l_discount < 0.095 then lpad(cast(cast(l_quantity as int) * 20 as string), 4, '0') end",
    "cast(case when l_discount < 0.095 then l_quantity - 20 end as float)",
    "cast(case when l_discount < 0.095 then greatest(l_quantity - 20, 0) end as float)",
    "cast(case when l_discount < 0.095 then case when l_quantity >= 35 then 1 else 0 end end as float)",
    "cast(case when l_discount < 0.095 then 0 else 1 end as float)",
    "case when l_discount >= 0.095 then l_returnflag end",
]))

FLIGHT_ROWS_SQL = (
    "select " + ", ".join(f"{value} as {name}" for name, value in FLIGHT_VALUES.items())
    + " from lineitem"
)

# The modelled flights, from the raw rows.
FLIGHTS_SQL = f"""
select distinct * replace (cast(trunc(cancelled) as integer) as cancelled),
  cast(year(fl_date) as integer) as year, cast(month(fl_date) as integer) as month
from ({FLIGHT_ROWS_SQL})
"""

# The modelled cases, from the orders.
CASES_SQL = """
select distinct o_orderpriority as country, o_orderstatus as continent,
  concat('G', cast(o_custkey % 100 as string)) as geoid,
  cast(trunc(o_totalprice) as integer) as cases,
  case when o_custkey % 10 <> 0 then cast(o_custkey % 100000 as integer) end as deaths,
  cast(o_orderdate as date) as daterep,
  cast(day(o_orderdate) as integer) as day, cast(month(o_orderdate) as integer) as month,
  cast(year(o_orderdate) as integer) as year
from orders
"""


def flight_rows(
    lineitem: DataFrame, change: Mapping[str, Callable[[Column], Column]] | None = None
) -> DataFrame:
    """Raw flight rows; ``change`` maps columns to functions of their values."""
    values = {n: F.expr(value) for n, value in FLIGHT_VALUES.items()}
    values |= {n: changed(values[n]) for n, changed in (change or {}).items()}
    return lineitem.select(*[value.alias(n.upper()) for n, value in values.items()])


def write_flight_files(
    lineitem: DataFrame, input_path: str, change: Mapping[str, Callable[[Column], Column]] | None = None
) -> str:
    """Flight rows, each of them twice, as compressed headered CSV.

    A row's line is made once and written twice, under the header as the name of its column. The
    writer leaves it as it is: no line holds the separator given here, nor is anything quoted again.
    """
    rows = flight_rows(lineitem, change)
    line = rows.select(F.to_csv(F.struct("*")).alias(",".join(rows.columns)), F.array(F.lit(1), F.lit(2)).alias("_copies"))
    twice = line.withColumn("_copy", F.explode("_copies")).drop("_copies", "_copy")
    as_it_is = {
        "sep": "\u0001", "quote": "", "escape": "", "escapeQuotes": False,
        "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
    }
    return _write_flight_rows(twice, input_path, **as_it_is)


def _write_flight_rows(rows: DataFrame, input_path: str, **options) -> str:
    path = f"{input_path}/{flights.INPUT.replace('*', '0')}"
    rows.write.options(maxRecordsPerFile=LINES, **options).csv(path, header=True, compression="gzip")
    return path


# Columns of an order that its record is made of.
_ORDER = ["o_orderdate", "o_totalprice", "o_custkey", "o_orderpriority", "o_orderstatus"]


def _record(order: Callable[[str], Column]) -> Column:
    day, customer = order("o_orderdate").cast("date"), order("o_custkey")
    deaths = F.when(customer % 10 == 0, "").otherwise((customer % 100000).cast("string"))
    return F.struct(
        F.date_format(day, "dd/MM/yyyy").alias("dateRep"),
        F.date_format(day, "dd").alias("day"),
        F.month(day).alias("month"),
        F.year(day).cast("string").alias("year"),
        order("o_totalprice").cast("decimal(18,2)").cast("string").alias("cases"),
        deaths.alias("deaths"),
        order("o_orderpriority").alias("countriesAndTerritories"),
        F.concat(F.lit("G"), (customer % 100).cast("string")).alias("geoId"),
        order("o_orderstatus").alias("continentExp"),
    )


def case_records(orders: DataFrame, *more: str) -> DataFrame:
    """One raw record per order; counts are text, some blank, some with a decimal tail.

    Columns of the orders named in ``more`` come along.
    """
    return orders.select(_record(F.col).alias("record"), *more)


def case_documents(orders: DataFrame, per_document: int) -> DataFrame:
    """Documents of a bounded number of records, which are made when the orders are together."""
    document = F.expr(f"monotonically_increasing_id() div {per_document}")
    numbered = orders.select(F.struct(*_ORDER).alias("order"), document.alias("document"))
    together = numbered.groupBy("document").agg(F.collect_list("order").alias("orders"))
    return together.select(F.transform("orders", lambda order: _record(lambda name: order[name])).alias("records"))


def write_case_documents(orders: DataFrame, input_path: str, per_document: int = 50_000) -> str:
    """Case records as compressed files of one document each, with a bounded number of records."""
    path = f"{input_path}/{cases.INPUT}"
    documents = case_documents(orders, per_document)
    documents.write.option("maxRecordsPerFile", 1).json(path, compression="gzip")
    return path


def write_case_lines(orders: DataFrame, input_path: str) -> str:
    """Case records as lines of one small document each."""
    path = f"{input_path}/{cases.INPUT}"
    case_records(orders).select(F.array("record").alias("records")).write.json(path)
    return path


# The modelled cases where every record comes twice, some days are no dates and some counts no numbers.
DIRTY_CASES_SQL = f"""
select distinct * replace (
  case when cases % 7 = 0 then null else daterep end as daterep, case when cases % 5 = 0 then null else deaths end as deaths
) from ({CASES_SQL})
"""


def write_dirty_documents(orders: DataFrame, input_path: str) -> str:
    """Case records, each of them twice, with one-digit dates, days that are no dates and odd counts."""
    count = F.floor("o_totalprice").cast("long")
    record = F.col("record")
    day = F.when(count % 7 == 0, "31/02/2020").otherwise(
        F.date_format(F.col("o_orderdate").cast("date"), "d/M/yyyy")
    )
    deaths = F.when(count % 5 == 0, "about 7").otherwise(record["deaths"])
    changed = record.withField("dateRep", day).withField("deaths", deaths)
    rows = case_records(orders, "o_totalprice", "o_orderdate").select(changed.alias("record"))
    path = f"{input_path}/{cases.INPUT}"
    rows.union(rows).select(F.array("record").alias("records")).write.json(path)
    return path


def document_lines(orders: DataFrame) -> DataFrame:
    """All case records as the lines of one document, in one task.

    Lines pass through that task one by one: their number, which is counted before, tells the
    last one, so that nothing is sorted to have the end at the end.
    """
    last = orders.count() - 1
    if last < 0:
        return orders.sparkSession.range(1).select(F.lit('{"records": []}').alias("value"))
    lines = case_records(orders).select(F.to_json("record").alias("value")).coalesce(1)
    # Numbers of the one task, from 0 without gaps.
    numbered = lines.select("value", F.monotonically_increasing_id().alias("line"))
    begin = F.when(F.col("line") == 0, '{"records": [').otherwise(",")
    end = F.when(F.col("line") == last, "\n]}").otherwise("")
    return numbered.select(F.concat(begin, "value", end).alias("value"))


def write_split_document(orders: DataFrame, input_path: str) -> str:
    """All case records as one document in one file, which one task writes line by line."""
    path = f"{input_path}/{cases.INPUT}"
    document_lines(orders).coalesce(1).write.text(path)
    return path


# Rows whose fields do not parse, and the text that stands there.
BROKEN_FIELDS = {
    "fl_date": ("l_linenumber = 3", "1996-13-45"),
    "origin_airport_id": ("l_linenumber = 5", "A12"),
    "dep_delay": ("l_quantity >= 49", "late"),
}


def write_broken_flight_files(lineitem: DataFrame, input_path: str) -> str:
    """Flight rows in which some fields do not parse."""
    change = {
        name: lambda value, where=where, text=text: F.when(F.expr(where), text).otherwise(value.cast("string"))
        for name, (where, text) in BROKEN_FIELDS.items()
    }
    return _write_flight_rows(flight_rows(lineitem, change), input_path)


def lookup_rows(df: DataFrame, code: str, description: str) -> DataFrame:
    """``code, description`` with commas and quotes inside the description."""
    return df.select(
        F.col(code).cast("string").alias("code"),
        F.format_string('%s, "%s"', F.col(description), F.col(code)).alias("description"),
    )


def write_lookup_file(rows: DataFrame, path: str) -> str:
    rows.write.csv(path, header=True, escape='"')
    return path


# Lookup table -> benchmark table, its code and its description column.
LOOKUP_ORIGINS = {
    "airport_id": ("part", "p_partkey", "p_name"),
    "airport_seq_id": ("supplier", "s_suppkey", "s_name"),
    "cancellation": ("region", "r_regionkey", "r_name"),
    "city_market_id": ("customer", "c_custkey", "c_name"),
    "state_abbreviation": ("nation", "n_nationkey", "n_name"),
    "world_area_codes": ("nation", "n_nationkey", "n_name"),
    "state_fips": ("region", "r_regionkey", "r_name"),
}


def _write_lookups(spark: SparkSession, sf_dir: str, path: str) -> None:
    for name, (origin, code, description) in LOOKUP_ORIGINS.items():
        rows = lookup_rows(table(spark, sf_dir, origin), code, description)
        write_lookup_file(rows, f"{path}/flights/{LOOKUP_FILES[name]}")


# Folders already written: (application, table folder, kind) -> (path, bytes).
_written: dict[tuple[str, str, str], tuple[str, int]] = {}
_locks: dict[tuple[str, str, str], Lock] = {}
_lock = Lock()


def _once(spark: SparkSession, sf_dir: str, kind: str, write: Callable[[str], object]) -> str:
    """The folder of one kind of raw files, written on first use in an application.

    It is written again when its files are no longer all there.
    """
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    with _lock:
        own = _locks.setdefault(key, Lock())
    with own:
        path, size = _written.get(key, ("", 0))
        try:
            if path and input_bytes(spark, path) == size:
                return path
        except AnalysisException:
            pass
        path = scratch_path(spark, kind)
        write(path)
        _written[key] = (path, input_bytes(spark, path))
        return path


def raw_cases(spark: SparkSession, sf_dir: str) -> str:
    """Input folder with the case documents."""
    orders = table(spark, sf_dir, "orders")
    return _once(spark, sf_dir, "cases", lambda path: write_case_documents(orders, path))


def raw_case_lines(spark: SparkSession, sf_dir: str) -> str:
    """Input folder with the case documents as lines."""
    orders = table(spark, sf_dir, "orders")
    return _once(spark, sf_dir, "case-lines", lambda path: write_case_lines(orders, path))


def raw_split_document(spark: SparkSession, sf_dir: str) -> str:
    """Input folder with one document of all cases."""
    orders = table(spark, sf_dir, "orders")
    return _once(spark, sf_dir, "split-document", lambda path: write_split_document(orders, path))


def raw_dirty_cases(spark: SparkSession, sf_dir: str) -> str:
    """Input folder with case lines that come twice and hold values that are lost."""
    orders = table(spark, sf_dir, "orders")
    return _once(spark, sf_dir, "dirty-cases", lambda path: write_dirty_documents(orders, path))


def raw_broken_flights(spark: SparkSession, sf_dir: str) -> str:
    """Input folder with flight files in which some fields do not parse."""
    lineitem = table(spark, sf_dir, "lineitem")
    return _once(spark, sf_dir, "broken-flights", lambda path: write_broken_flight_files(lineitem, path))


def raw_flights(spark: SparkSession, sf_dir: str) -> str:
    """Input folder with the flight files."""
    lineitem = table(spark, sf_dir, "lineitem")
    return _once(spark, sf_dir, "flights", lambda path: write_flight_files(lineitem, path))


def raw_lookups(spark: SparkSession, sf_dir: str) -> str:
    """Input folder with the seven lookup files."""
    return _once(spark, sf_dir, "lookups", lambda path: _write_lookups(spark, sf_dir, path))


def lookup_file(input_path: str, name: str) -> str:
    return f"{input_path}/flights/{LOOKUP_FILES[name]}"
