import glob

import pyarrow.parquet as pq
from helpers import conf
from pyspark.sql import functions as F

from dailyfacts.operators.layout import range_layout
from dailyfacts.operators.writes import write_by_month


def months(spark, months_of_year, n=50, hot=0):
    """n rows per month of 2020, hot more rows in January."""
    rows = [(2020, m, i) for m in months_of_year for i in range(n)] + [(2020, 1, -i - 1) for i in range(hot)]
    return spark.createDataFrame(rows, "year int, month int, v int").withColumns(
        {"_year": F.col("year"), "_month": F.col("month")}
    )


def test_roundtrip_keeps_months_inside_files(spark, tmp_path):
    path = str(tmp_path / "t")
    write_by_month(months(spark, [1, 2, 3]), path)
    back = spark.read.parquet(path)
    assert back.columns == ["year", "month", "v", "_year", "_month"]
    assert back.count() == 150 and back.where("year <> _year or month <> _month").count() == 0
    for month in (1, 2, 3):
        assert len(glob.glob(f"{path}/_year=2020/_month={month}/*.parquet")) == 1


def test_overwrite_all_or_months(spark, tmp_path):
    path = str(tmp_path / "t")
    write_by_month(months(spark, [1, 2, 3]), path)
    write_by_month(months(spark, [2], n=7), path, replace="months")
    assert spark.read.parquet(path).groupBy("_month").count().orderBy("_month").collect() == [(1, 50), (2, 7), (3, 50)]
    write_by_month(months(spark, [2], n=9), path)
    assert spark.read.parquet(path).groupBy("_month").count().collect() == [(2, 9)]


def test_null_date_goes_to_the_default_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(None, None, 1)], "year int, month int, v int")
    write_by_month(df.withColumns({"_year": F.col("year"), "_month": F.col("month")}), path)
    assert glob.glob(f"{path}/_year=__HIVE_DEFAULT_PARTITION__/_month=__HIVE_DEFAULT_PARTITION__/*.parquet")
    assert spark.read.schema("v int, _year int, _month int").parquet(path).collect() == [(1, None, None)]


def test_hot_month_is_split_over_tasks(spark, tmp_path):
    path = str(tmp_path / "t")
    sizes = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
    }
    with conf(spark, sizes):
        df = spark.range(0, 40_000, 1, 8).select(
            F.lit(2020).alias("year"),
            F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id") % 12 + 1).cast("int").alias("month"),
            F.sha2(F.col("id").cast("string"), 256).alias("v"),
        )
        write_by_month(df.withColumns({"_year": F.col("year"), "_month": F.col("month")}), path)
    assert len(glob.glob(f"{path}/_year=2020/_month=1/*.parquet")) > 3
    assert spark.read.parquet(path).count() == 40_000


def test_range_layout_spreads_a_hot_key_and_sorts(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(0, 20_000, 1, 4).select(F.when(F.col("id") % 10 > 0, 5).otherwise(F.col("id") % 10).alias("k"), "id")
    with conf(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        range_layout(df, "k").write.parquet(path)
    files = glob.glob(f"{path}/*.parquet")
    with_hot = 0
    for file in files:
        keys = pq.read_table(file).column("k").to_pylist()
        assert keys == sorted(keys)
        with_hot += 5 in keys
    assert with_hot > 1
    assert spark.read.parquet(path).count() == 20_000
