"""File readers. Paths may be files, folders, globs or lists of them, on any file system."""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dailyfacts.schemas import (
    CASE_DOCUMENT_SCHEMA,
    FLIGHT_FILE_COLUMNS,
    LOOKUP_COLUMNS,
    MONTH_PARTITIONS,
    TableSpec,
    ddl,
)
from dailyfacts.session import hadoop_settings

# Placeholder for the empty column that a trailing comma in the file makes.
_TRAILING = "_trailing"


def read_case_documents(spark: SparkSession, path, *, multi_line: bool = True) -> DataFrame:
    """Documents ``{"records": [...]}``, one row each.

    A pretty-printed document is parsed by one task, so large inputs should come
    as many documents; with ``multi_line=False`` each line is a document and files
    are split. The schema is given, which saves the inference pass. A document that
    is not valid JSON fails the read: nulling it would drop all its records unseen.
    """
    return spark.read.schema(CASE_DOCUMENT_SCHEMA).json(
        path, multiLine=multi_line, mode="FAILFAST"
    )


#: Column with the line of a row in which a field did not parse.
RAW_LINE = "_raw"


class SurplusColumn(ValueError):
    """A file has a named column that the schema does not know."""


def file_paths(spark: SparkSession, path) -> list[str]:
    """Paths of the files under ``path``; they are listed, not read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return [row["path"] for row in listed.select("path").collect()]


def first_lines(spark: SparkSession, paths: list[str]) -> list[str | None]:
    """The first line that is not blank of each file, or None; nothing behind it is parsed.

    A file takes some calls of its file system and no job, as there may be thousands of them.
    """
    jvm, settings = spark._jvm, hadoop_settings(spark)
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(settings)

    def first(path: str) -> str | None:
        file = jvm.org.apache.hadoop.fs.Path(path)
        stream, codec = file.getFileSystem(settings).open(file), codecs.getCodec(file)
        text = codec.createInputStream(stream) if codec else stream
        lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(text, "UTF-8"))
        try:
            while (line := lines.readLine()) is not None and not line.strip():
                pass
            return line
        finally:
            lines.close()

    with ThreadPoolExecutor(max_workers=16) as pool:
        return list(pool.map(first, paths))


def check_surplus_columns(spark: SparkSession, path) -> None:
    """Fail when a file has more columns than the schema, but for one without a name at the end.

    The scan compares only the names of the columns that it reads, so values of further ones
    would go unseen. The first line of each file is read for this, several files at a time;
    files with the same one have the same columns, so that one of these is parsed.
    """
    known, paths, kinds = len(FLIGHT_FILE_COLUMNS), file_paths(spark, path), {}
    for line, file in zip(first_lines(spark, paths), paths):
        kinds.setdefault(line, file)
    for file in kinds.values():
        more = spark.read.csv(file, header=True).columns[known:]
        # The reader names a nameless column after its place.
        if more and not (len(more) == 1 and re.fullmatch(r"_c\d+", more[0])):
            raise SurplusColumn(f"{file} has columns that are not known: {', '.join(more)}")


def read_flight_days(spark: SparkSession, path) -> DataFrame:
    """``FL_DATE`` of the lines of flight files, headers too; no other field is parsed.

    For counts that plan a read: the text before the first comma is taken for the date, null where it is none.
    """
    field = F.btrim(F.substring_index("value", ",", 1), F.lit('" '))
    return spark.read.text(path).select(field.try_cast("date").alias("FL_DATE"))


def read_flight_files(
    spark: SparkSession, path, *, check_header: bool = True, raw_line: bool = False
) -> DataFrame:
    """Flight rows from headered CSV, typed by position.

    A field that does not parse becomes null and the rest of its row is kept, a
    short row is filled with nulls, a trailing empty column is ignored. Because
    names are not used to bind columns, every file's header is compared with the
    schema while it is read; a file with other columns or another order fails, and
    one with further named columns before that. ``raw_line`` adds a column that holds
    the line of each row in which a field did not parse.
    """
    if check_header:
        check_surplus_columns(spark, path)
    columns = [(name.upper(), kind) for name, kind in FLIGHT_FILE_COLUMNS]
    hidden = [(_TRAILING, "string"), (RAW_LINE, "string")]
    rows = spark.read.schema(ddl([*columns, *hidden])).csv(
        path, header=True, enforceSchema=not check_header, columnNameOfCorruptRecord=RAW_LINE
    )
    # Dropping the placeholder prunes it from the scan, and with it from the check.
    return rows.drop(_TRAILING) if raw_line else rows.drop(_TRAILING, RAW_LINE)


def read_lookup_file(spark: SparkSession, path) -> DataFrame:
    """``code, description`` rows; quotes inside a value are doubled, empty fields are null.

    A row with more or fewer fields fails the read: cutting or filling it would change
    the lookup unseen.
    """
    return spark.read.schema(ddl(LOOKUP_COLUMNS)).csv(
        path, header=True, escape='"', mode="FAILFAST"
    )


def read_csv_inferred(spark: SparkSession, path) -> DataFrame:
    """Headered CSV with inferred types, for profiling raw files.

    Inference reads the input once more than a reader with a schema does.
    """
    return spark.read.csv(path, header=True, inferSchema=True)


def read_json_inferred(spark: SparkSession, path, *, multi_line: bool = True) -> DataFrame:
    """JSON with inferred types, for profiling raw files."""
    return spark.read.json(path, multiLine=multi_line)


def read_model(
    spark: SparkSession, path, spec: TableSpec, *, keep_partitions: bool = False
) -> DataFrame:
    """A month-partitioned Parquet dataset in table column order.

    ``keep_partitions`` keeps ``_year, _month``; filters on those two columns, and
    only on those, skip whole folders.
    """
    partitions = [(name, "int") for name in MONTH_PARTITIONS]
    rows = spark.read.schema(ddl([*spec.columns, *partitions])).parquet(path)
    return rows if keep_partitions else rows.drop(*MONTH_PARTITIONS)
