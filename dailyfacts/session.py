"""Session factory and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_MB = 1024 * 1024

# Names of compressed files, and how many times larger their text is at least.
_COMPRESSED = r"\.(gz|bz2|deflate|lz4|snappy|zst)$"
_EXPANDS = 8


def build_session(
    app_name: str = "dailyfacts",
    *,
    packages: str | None = None,
    commit_algorithm: int | None = None,
    **conf: str,
) -> SparkSession:
    """Get or create the session.

    ``packages`` adds an object-store connector matching the cluster's Hadoop.
    ``commit_algorithm=2`` renames task output earlier, which is faster on object
    stores but leaves partial output behind when a job fails; the default keeps
    the safe algorithm. Other keywords are settings with ``__`` for the dot:
    ``spark__sql__shuffle__partitions="4000"``.
    """
    builder = SparkSession.builder.appName(app_name)
    if packages:
        builder = builder.config("spark.jars.packages", packages)
    if commit_algorithm is not None:
        builder = builder.config(
            "spark.hadoop.mapreduce.fileoutputcommitter.algorithm.version", str(commit_algorithm)
        )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def _listed(spark: SparkSession, path) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)


def input_bytes(spark: SparkSession, path) -> int:
    """Total size of the files under ``path``; they are listed, not read."""
    return _listed(spark, path).agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def size_for_input(
    spark: SparkSession,
    path,
    *,
    partition_bytes: int = 512 * _MB,
    max_partitions: int = 50_000,
    max_splits: int = 100_000,
) -> None:
    """Raise the number of shuffle partitions and the split size to fit the input.

    A dedupe shuffles all of its input, and a few hundred partitions of 100 TB would be
    too large for any executor. Adaptive execution merges partitions that turn out
    small but never splits those of an aggregate. Past the two limits partitions and
    splits grow instead, since the driver keeps a record per split of all partitions.
    Partitions are only ever raised, and a split size that was set is left alone.

    Compressed files count for the text in them. They are not split but put together in
    splits by their size on disk, so that splits are made smaller for them.
    """
    packed = F.col("path").rlike(_COMPRESSED)
    sizes = _listed(spark, path).select(F.when(packed, F.col("length")).otherwise(0).alias("packed"), "length")
    on_disk, compressed = sizes.agg(
        F.coalesce(F.sum("length"), F.lit(0)), F.coalesce(F.sum("packed"), F.lit(0))
    ).first()
    total = on_disk + compressed * (_EXPANDS - 1)
    partitions = min(ceil(total / partition_bytes), max_partitions)
    if partitions > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    usual = 128 * _MB // _EXPANDS if compressed else 128 * _MB
    split = max(ceil(on_disk / max_splits), usual)
    if split != 128 * _MB and "spark.sql.files.maxPartitionBytes" not in spark.conf.getAll:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))


# Removes shuffle files when the query that wrote them ends, and not some time after.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_SIZES = ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes", _CLEANUP)


@contextmanager
def sized_for(spark: SparkSession, paths: str | Sequence[str], **limits: int) -> Iterator[None]:
    """Sizes for the files at ``paths`` within a block; the session's own are put back after it.

    Within it, each write removes its shuffle files at its end: else those of all steps would lie
    on the executors' disks together, until the driver's memory is next collected.

    Settings hold for a whole session: jobs that run at once share one block.
    """
    before = {key: value for key, value in spark.conf.getAll.items() if key in _SIZES}
    size_for_input(spark, paths, **limits)
    if _CLEANUP not in before:
        spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        for key in _SIZES:
            if key in before:
                spark.conf.set(key, before[key])
            else:
                spark.conf.unset(key)


def hadoop_settings(spark: SparkSession):
    """The settings of file systems, with those of the session, as its reads and writes take them."""
    return spark._jsparkSession.sessionState().newHadoopConf()


def _file_system(spark: SparkSession, path: str):
    """The Hadoop path of a name, and its file system."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(hadoop_settings(spark))


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name under the cluster's shared scratch folder.

    The folder comes from ``spark.checkpoint.dir``, else from the context's checkpoint
    folder, else from the warehouse. A warehouse on the driver's own disk, as the default
    is, is refused on a cluster: executors would each write to theirs.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        set_before = spark.sparkContext._jsc.sc().getCheckpointDir()
        base = set_before.get() if set_before.isDefined() else spark.conf.get("spark.sql.warehouse.dir")
        if not set_before.isDefined() and base.startswith("file:") and not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{base} is no shared folder: set spark.checkpoint.dir to one")
    return f"{base.rstrip('/')}/dailyfacts-{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch_folder(spark: SparkSession, label: str, beside: str | None = None) -> Iterator[str]:
    """A new scratch folder that is removed, with all that is in it, at the end of the block.

    With ``beside`` it is a hidden neighbour of that folder, on the same file system, so that
    what is written there can be moved into it.
    """
    if beside:
        named, files = _file_system(spark, beside)
        folder = files.makeQualified(named)
        path = f"{folder.getParent() or folder}/.{folder.getName()}-{label}-{uuid.uuid4().hex}"
    else:
        path = scratch_path(spark, label)
    try:
        yield path
    finally:
        folder, files = _file_system(spark, path)
        files.delete(folder, True)


def move_into(spark: SparkSession, source: str, target: str, names: Sequence[str]) -> None:
    """Move files or folders of ``source`` to ``target``, of the same file system, in place of old ones.

    It takes what the commit of a dynamic overwrite takes: a removal and a rename for each
    name. Names that ``source`` does not have stay as they are.
    """
    for name in names:
        new, files = _file_system(spark, f"{source}/{name}")
        if not files.exists(new):
            continue
        old, _ = _file_system(spark, f"{target}/{name}")
        files.delete(old, True)
        files.mkdirs(old.getParent())
        if not files.rename(new, old):
            raise OSError(f"{new} could not be moved to {old}")
    # Plans that were cached over the files moved away are no longer used.
    spark.catalog.refreshByPath(target)
