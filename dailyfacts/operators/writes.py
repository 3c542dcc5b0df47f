"""Month-partitioned Parquet sink."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from dailyfacts.operators.digests import changed_months, month_folders, record_digests
from dailyfacts.operators.layout import cluster_for_write
from dailyfacts.schemas import MONTH_PARTITIONS
from dailyfacts.session import move_into, scratch_folder


def write_by_month(
    df: DataFrame,
    path: str,
    *,
    replace: str = "all",
    cluster_by: Sequence[str] = MONTH_PARTITIONS,
) -> int | None:
    """Overwrite the dataset at ``path``, partitioned by ``_year, _month``.

    ``replace="all"`` removes every old partition. ``replace="months"`` removes only
    the months present in ``df``, for loads of the last days. ``replace="changed"`` of these
    writes only the months whose rows are others than those written before, and returns
    their number: the files of the other months stay as they are. Rows without a date go
    to the default partition. An empty ``cluster_by`` skips the extra shuffle and
    leaves one file per task and month; changed months are then staged beside ``path``
    and moved, so that no row is written twice.
    """
    if replace == "changed":
        return _write_changed(df, path, cluster_by)
    modes = {"all": "static", "months": "dynamic"}
    rows = cluster_for_write(df, *cluster_by) if cluster_by else df
    (
        rows.write.partitionBy(*MONTH_PARTITIONS)
        .mode("overwrite")
        .option("partitionOverwriteMode", modes[replace])
        .parquet(path)
    )


def _write_changed(df: DataFrame, path: str, cluster_by: Sequence[str]) -> int:
    # Rows that need no shuffle are written once: as the dataset has them, to be moved there.
    spark, placed = df.sparkSession, not cluster_by
    with scratch_folder(spark, "months", path if placed else None) as scratch:
        rows, months = changed_months(df, path, scratch, by_month=placed)
        n = months.count()
        if n and placed:
            # The mark of a whole write comes last, as Spark has it.
            move_into(spark, f"{scratch}/rows", path, [*month_folders(months), "_SUCCESS"])
        elif n:
            write_by_month(rows, path, replace="months", cluster_by=cluster_by)
        if n:
            record_digests(months, path)
    return n
