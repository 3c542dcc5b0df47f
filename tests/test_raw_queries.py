"""Registered queries on tables that sf0.1 is not like: copies of rows, few rows, none."""

import datetime as dt
import gzip
import json
from pathlib import Path

import compare
import pytest
from helpers import executed_plan
from pyspark.sql import functions as F

import __spark_entry__ as contract
from dailyfacts.catalogue import raw
from dailyfacts.catalogue.raw import document_lines
from dailyfacts.session import input_bytes, sized_for
from dailyfacts.sources import read_flight_files

ORDER = "{key}, {customer}, 'O', {price}D, timestamp_ntz '1996-03-0{day} 00:00:00', '5-LOW'"
ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")


def put_orders(spark, folder, orders):
    rows = [ORDER.format(**order) for order in orders]
    values = spark.sql("select * from values " + ", ".join(f"({row})" for row in rows)).toDF(*ORDER_COLUMNS)
    typed = values.selectExpr("cast(o_orderkey as bigint)", "cast(o_custkey as bigint)", *ORDER_COLUMNS[2:])
    typed.coalesce(1).write.parquet(str(folder / "parts"))
    next((folder / "parts").glob("*.parquet")).rename(folder / "orders.parquet")
    return str(folder)


@pytest.mark.parametrize("name", ["json_explode_model", "json_split_document"])
def test_records_that_become_equal_rows_stay(spark, tmp_path, name):
    # Two orders of one customer and day whose prices differ only behind the point.
    orders = [{"key": k, "customer": 7 + k // 3, "price": 100.25 + k % 3 / 4, "day": 1} for k in range(6)]
    sf_dir = put_orders(spark, tmp_path, orders)
    df = contract.queries()[name](spark, sf_dir)
    assert compare.compare(df, compare.connect(sf_dir), contract.oracle_sql()[name]) == ""
    assert df.count() == 6


def test_the_one_document_is_written_without_a_sort(spark, tmp_path):
    orders = spark.read.parquet(put_orders(spark, tmp_path, [{"key": k, "customer": k, "price": k, "day": 1} for k in range(9)]))
    for rows in (orders, orders.repartition(3), orders.limit(1), orders.limit(0)):
        lines = document_lines(rows)
        document = json.loads("\n".join(row["value"] for row in lines.collect()))
        assert len(document["records"]) == rows.count()
        assert lines.rdd.getNumPartitions() <= 1 or not document["records"]
        assert "Sort" not in executed_plan(lines)


def test_documents_are_made_of_orders_that_are_together(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    documents = raw.case_documents(orders, 100)
    assert documents.where("size(records) > 100").isEmpty()
    records = documents.selectExpr("inline(records)")
    plain = raw.case_records(orders).select("record.*")
    assert records.dtypes == plain.dtypes
    assert records.exceptAll(plain).isEmpty() and plain.exceptAll(records).isEmpty()
    # What is shuffled is the orders, not the longer records.
    plan = documents._jdf.queryExecution().optimizedPlan().toString()
    together, before = plan[plan.index("Aggregate") :].split("\n", 1)
    assert "date_format" in together and "order" in before and "date_format" not in before


def test_flight_files_are_compressed_and_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(raw, "LINES", 500)
    lineitem = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").limit(1200).repartition(1)
    for name, write, times in (("a", raw.write_flight_files, 2), ("b", raw.write_broken_flight_files, 1)):
        path = write(lineitem, str(tmp_path / name))
        files = [p for p in Path(path).iterdir() if p.name.startswith("part-")]
        assert files and all(p.suffix == ".gz" for p in files)
        rows = [spark.read.csv(str(p), header=True).count() for p in files]
        assert max(rows) == 500 and sum(rows) == 1200 * times
    twice = read_flight_files(spark, str(tmp_path / "a/flights")).groupBy("TAIL_NUM", "FL_DATE", "ORIGIN_AIRPORT_ID").count()
    assert twice.where("count % 2 = 1").isEmpty()


def test_lines_made_once_are_those_of_the_writer(spark, tmp_path):
    flags = ["R", "", " x ", 'q"u', "a,b", "back\\", "#", "é", None]
    lineitem = spark.createDataFrame(
        [(k, k, None if k == 3 else 7, k % 7 + 1, float(k * 9), 0.01 * k, flag, "O", dt.datetime(1996, 3, 1 + k) if k else None)
         for k, flag in enumerate(flags)],
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double,"
        " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    ).coalesce(1)
    change = {"tail_num": lambda tail: F.concat(F.lit(" "), tail)}
    for name, changes in (("a", None), ("b", change)):
        path = raw.write_flight_files(lineitem, str(tmp_path / name), changes)
        raw.flight_rows(lineitem, changes).write.csv(str(tmp_path / f"{name}-plain"), header=True)
        lines, plain = (
            [line for file in sorted(Path(p).glob("part-*")) for line in opened(file, "rt", encoding="utf-8").read().split("\n")[:-1]]
            for p, opened in ((path, gzip.open), (tmp_path / f"{name}-plain", open))
        )
        assert lines[0] == plain[0] and lines[1::2] == lines[2::2] == plain[1:] and len(plain) == 10
    # Half as many lines are made as are written.
    made = []
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(raw, "_write_flight_rows", lambda rows, path, **options: made.append(rows))
        raw.write_flight_files(lineitem, "")
    plan = made[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("to_csv")


def test_jobs_are_sized_by_the_text_in_compressed_files(spark, tmp_path):
    keys = ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes")
    spark.range(20_000).selectExpr("cast(id as string)").coalesce(1).write.text(str(tmp_path / "t"), compression="gzip")
    size = input_bytes(spark, str(tmp_path))
    before = [spark.conf.get(k) for k in keys]
    with sized_for(spark, str(tmp_path), partition_bytes=size // 10):
        assert int(spark.conf.get(keys[0])) >= 70
        assert int(spark.conf.get(keys[1])) == 16 << 20
    assert [spark.conf.get(k) for k in keys] == before
