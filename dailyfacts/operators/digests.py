"""Digests of the months of a dataset, to tell which of them a new load changes.

A digest is the number of rows and two hashes over them that do not depend on their order.
It is kept in a hidden folder of the dataset, together with a hash of the names of the
month's files: files that anything else has written since make it invalid.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dailyfacts.schemas import MONTH_PARTITIONS
from dailyfacts.session import scratch_path

_FOLDER = "_digests"
_DIGEST = ["n", "sums", "bits"]
_KINDS = "n bigint, sums decimal(38,0), bits bigint, files decimal(38,0), _year int, _month int"


def _sum_of(hashed: Column) -> Column:
    return F.sum(hashed.cast("decimal(20,0)")).cast("decimal(38,0)")


def digests(df: DataFrame) -> DataFrame:
    """``_year, _month, n, sums, bits``: a row for each month, aggregated inside the tasks first."""
    columns = [F.col(f"`{name}`") for name in df.columns]
    return df.groupBy(*MONTH_PARTITIONS).agg(
        F.count(F.lit(1)).alias("n"), _sum_of(F.xxhash64(*columns)).alias("sums"),
        F.bit_xor(F.xxhash64(F.lit(1), *columns)).alias("bits"),
    )


def _same_month(left: DataFrame, right: DataFrame):
    year, month = MONTH_PARTITIONS
    return left[year].eqNullSafe(right[year]) & left[month].eqNullSafe(right[month])


def _files(df: DataFrame) -> DataFrame:
    """``_year, _month, files``: a hash of the names of each month's files. No column is read."""
    names = df.select(*MONTH_PARTITIONS, F.col("_metadata.file_name").alias("name")).distinct()
    return names.groupBy(*MONTH_PARTITIONS).agg(_sum_of(F.xxhash64("name")).alias("files"))


def _stored(df: DataFrame, path: str) -> DataFrame | None:
    """The digests that hold for the files now at ``path``."""
    spark = df.sparkSession
    try:
        stored = spark.read.schema(_KINDS).parquet(f"{path}/{_FOLDER}")
        now = _files(spark.read.schema(df.schema).parquet(path))
    except AnalysisException:
        return None
    return stored.join(now, _same_month(stored, now) & (stored["files"] == now["files"]), "left_semi")


def _scratch(df: DataFrame, path: str, *partitions: str) -> DataFrame:
    df.write.partitionBy(*partitions).parquet(path)
    # Partition columns come last in a scan; the hashes of a row are over the order of ``df``.
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*[f"`{name}`" for name in df.columns])


def changed_months(
    df: DataFrame, path: str, scratch: str | None = None, *, by_month: bool = False
) -> tuple[DataFrame, DataFrame]:
    """The rows of the months of ``df`` that differ from what is at ``path``, and their digests.

    ``df`` is computed once, into a ``scratch`` folder, which both results are read from. Months are
    few, as the calendar bounds them, so that lists of them are broadcast. With ``by_month`` the rows
    lie in ``{scratch}/rows`` as the dataset has them, in a folder for each month (:func:`month_folders`).
    """
    scratch = scratch or scratch_path(df.sparkSession, "months")
    rows = _scratch(df, f"{scratch}/rows", *(MONTH_PARTITIONS if by_month else ()))
    new, old = digests(rows), _stored(df, path)
    if old is not None:
        known = [new[name].eqNullSafe(old[name]) for name in _DIGEST]
        same = _same_month(new, old)
        for part in known:
            same = same & part
        new = new.join(F.broadcast(old), same, "left_anti")
    months = _scratch(new, f"{scratch}/digests")
    changed = months.select(*MONTH_PARTITIONS)
    return rows.join(F.broadcast(changed), _same_month(rows, changed), "left_semi"), months


def month_folders(months: DataFrame) -> list[str]:
    """Names of the folders that hold ``months`` in a dataset."""
    found = months.select(*MONTH_PARTITIONS).collect()
    none = "__HIVE_DEFAULT_PARTITION__"
    return ["/".join(f"{k}={none if v is None else v}" for k, v in row.asDict().items()) for row in found]


def record_digests(months: DataFrame, path: str) -> None:
    """Keep the digests of months that have just been written to ``path``.

    A job that ends before this leaves digests whose files are gone; they no longer count.
    """
    spark = months.sparkSession
    now = _files(spark.read.parquet(path))
    kept = months.join(F.broadcast(now), _same_month(months, now)).select(
        *_DIGEST, now["files"], *[months[name] for name in MONTH_PARTITIONS]
    )
    # Rows of earlier files stay behind; they hold for no file any more.
    kept.coalesce(1).write.mode("append").parquet(f"{path}/{_FOLDER}")
