"""What the operators share: scratch tables, free column names, native words."""

from __future__ import annotations

import ctypes
import gc
import sys
import threading
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from itertools import islice

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from dailyfacts.session import scratch_path

#: White space between words: blank, tab, newline, vertical tab, form feed, return.
WORD_BREAK = r"[\x20\x09-\x0D]+"


# Folders of the blocks of ``scratch_scope`` that this thread is in.
_open = threading.local()


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Tables that :func:`kept` writes within the block are removed at its end.

    For work whose result is written within the block, too, as ``lasting``.
    """
    outer, _open.folders = getattr(_open, "folders", None), []
    try:
        yield
    finally:
        folders, _open.folders = _open.folders, outer
        for folder in folders:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def kept(df: DataFrame, label: str, lasting: bool = False) -> DataFrame:
    """``df`` written to the shared scratch folder and read back.

    Cuts the lineage where a result is used several times; a lost executor costs the
    tasks it ran and not the steps before.
    """
    path = scratch_path(df.sparkSession, label)
    folders = getattr(_open, "folders", None)
    if folders is not None and not lasting:
        folders.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, base: str) -> str:
    """``base`` with as many underscores before it as keep it apart from the columns of ``df``."""
    taken = {name.lower() for name in df.columns}
    while base.lower() in taken:
        base = f"_{base}"
    return base


def words(text: Column) -> Column:
    """Array of the words of a text, empty for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_BREAK), "")


def remainder(key: Column, by: int) -> Column:
    """``crc32`` of the key as text, modulo ``by``; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % by


def chunks(rows: Iterable[tuple], size, limit: int):
    """Lists of rows whose sizes add up to about ``limit``; no row is cut."""
    batch, total = [], 0
    for row in rows:
        batch.append(row)
        total += size(row)
        if total >= limit:
            yield batch
            batch, total = [], 0
    if batch:
        yield batch


def in_frames(
    rows: DataFrame, apply: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str,
    keeps_cache: bool = False,
) -> DataFrame:
    """``rows.mapInPandas`` in which whole numbers stay exact beside nulls.

    At its end a task gives back the memory that its worker does not use, as the worker waits
    for other tasks beside the executor.

    pandas would turn all of a batch's numbers into floating point for one null; columns that
    hold one are nullable integers here. Workers drop the caches of earlier stages, unless
    ``apply`` has one of its own.
    """
    fields = to_arrow_schema(StructType.fromDDL(schema))

    def exact(batch: pa.RecordBatch) -> pd.DataFrame:
        frame = batch.to_pandas()
        for name, column in zip(batch.schema.names, batch.columns, strict=True):
            if column.null_count and pa.types.is_integer(column.type):
                frame[name] = pd.array(column.to_pylist(), dtype="Int64")
        return frame

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keeps_cache:
            process_cache(None)
        for frame in apply(map(exact, batches)):
            yield pa.RecordBatch.from_pandas(frame, schema=fields, preserve_index=False)
        frame = None
        give_back()

    return rows.mapInArrow(frames, schema)


@contextmanager
def small_batches(spark: SparkSession, size: str = "8m") -> Iterator[None]:
    """Arrow batches of fewer bytes for what runs within a block: workers hold each several times."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.getAll.get(name)
    spark.conf.set(name, size)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def give_back() -> None:
    """Return freed memory of this process to the system, as far as its libraries know how."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def process_cache(name: str | None) -> dict:
    """A dictionary that lives as long as the Python worker and serves all tasks of one operator.

    Those of other operators go, so that a reused worker does not hold the memory of earlier
    stages; without a name all go.
    """
    caches = sys.__dict__.setdefault("_dailyfacts_caches", {})
    for other in caches.keys() - {name}:
        del caches[other]
    return caches.setdefault(name, {}) if name else {}


def forget_oldest(remembered: dict, most: int) -> None:
    """Of a dictionary with more than ``most`` entries, drop the half that came first."""
    if len(remembered) > most:
        for key in list(islice(remembered, len(remembered) - most // 2)):
            del remembered[key]
