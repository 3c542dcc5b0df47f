"""Catalog tables: drop, create, load by name, required columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dailyfacts.operators.filters import any_null
from dailyfacts.operators.layout import by_ranges, file_ranges, shared, without_files
from dailyfacts.operators.quality import CheckResult, Rule
from dailyfacts.schemas import TableSpec, ddl
from dailyfacts.sources.tables import qualified, read_table


#: Table property that names the columns of the sort key.
SORT_KEY = "dailyfacts.sort_key"


def drop_table(spark: SparkSession, spec: TableSpec, database: str | None = None) -> None:
    """Drop the table and what was recorded of its files."""
    spark.sql(f"DROP TABLE IF EXISTS {qualified(spec, database)}")
    if spec.sort_by:
        spark.sql(f"DROP TABLE IF EXISTS {qualified(ranges_of(spec), database)}")


def create_table(spark: SparkSession, spec: TableSpec, database: str | None = None) -> None:
    """Create the table unless it is there; its sort key is one of its properties."""
    partitions = ", ".join(f"`{name}`" for name in spec.partition_by)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {qualified(spec, database)} ({ddl(spec.columns)}) USING parquet"
        + (f" PARTITIONED BY ({partitions})" if partitions else "")
        + (f" TBLPROPERTIES ('{SORT_KEY}' = '{','.join(spec.sort_by)}')" if spec.sort_by else "")
    )


def require_columns(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Fail the running job at the first null in a required column.

    Parquet tables accept nulls whatever their definition says. The check sits in the
    projection of the load itself, so it costs no extra pass, and a job that fails
    commits nothing.
    """
    missing = {
        name: F.coalesce(F.col(name), F.raise_error(F.lit(f"{spec.title}.{name} is null")))
        for name in spec.required
    }
    return df.withColumns(missing) if missing else df


def split_required(df: DataFrame, spec: TableSpec) -> tuple[DataFrame, DataFrame]:
    """Rows that satisfy the required columns, and the others with the names they miss."""
    bad = any_null(spec.required)
    names = F.array_compact(
        F.array(*[F.when(F.col(n).isNull(), F.lit(n)) for n in spec.required])
    )
    return df.where(~bad), df.where(bad).withColumn("missing", names)


def load_table(
    spark: SparkSession,
    spec: TableSpec,
    df: DataFrame,
    database: str | None = None,
    rules: Sequence[Rule] = (),
) -> list[CheckResult]:
    """Append ``df`` to the table, matching columns by name; the results of ``rules`` over it.

    A table with a sort key is laid out by it: every file covers a range of the key within
    its partition, months or keys with many rows are split over several files, and
    what each file covers is recorded for :func:`read_range`. The order begins with the
    partition columns, which is what the partitioned writer asks for, so that its own sort
    is not added on top. Finding the ranges reads ``df`` once more.

    Rules are counted while the rows are written, not by a scan of the table. A task that
    runs twice may count twice, so they are for rules that expect no row at all.
    """
    if any(rule.expected for rule in rules):
        raise ValueError("a rule that is counted during the load can only expect 0 rows")
    rows = require_columns(df.select(*spec.column_names), spec)
    if spec.sort_by:
        rows = by_ranges(rows, *sort_order(spec))
    seen = Observation()
    if rules:
        # Above the shuffle, since finding the ranges runs what is below it once more.
        rows = rows.observe(seen, *[F.count_if(rule.bad).alias(f"r{i}") for i, rule in enumerate(rules)])
    if spec.sort_by:
        rows = rows.sortWithinPartitions(*sort_order(spec))
    spark.sql(f"INSERT INTO {qualified(spec, database)} BY NAME SELECT * FROM {{rows}}", rows=rows)
    if spec.sort_by:
        record_ranges(spark, spec, database)
    counts = seen.get if rules else {}
    return [CheckResult(rule.name, counts[f"r{i}"], rule.expected) for i, rule in enumerate(rules)]


def load_good_rows(
    spark: SparkSession,
    spec: TableSpec,
    df: DataFrame,
    rejects: str,
    database: str | None = None,
    rules: Sequence[Rule] = (),
) -> list[CheckResult]:
    """Append the rows with all required columns; the others go to Parquet files at ``rejects``.

    Other than :func:`load_table` alone, a null fails nothing: rejected rows are kept with the
    names of the columns that they miss. Both writes, and the finding of the ranges, use one
    computation of ``df``, which is persisted meanwhile: computing it again for each would read,
    parse and dedupe the raw files up to three times.
    """
    with shared(df.select(*spec.column_names)) as rows:
        good, bad = split_required(rows, spec)
        # First, so that a load that succeeds has its rejects.
        bad.write.mode("overwrite").parquet(rejects)
        return load_table(spark, spec, good, database, rules)


def sort_order(spec: TableSpec) -> list[str]:
    """The partition columns and then the other columns of the sort key."""
    return [*spec.partition_by, *[name for name in spec.sort_by if name not in spec.partition_by]]


def ranges_of(spec: TableSpec) -> TableSpec:
    """The table that says which range of the sort key each file covers."""
    kinds = dict(spec.columns)
    ends = [(f"{end}_{c}", kinds[c]) for c in spec.sort_by for end in ("low", "high")]
    return TableSpec(f"{spec.name}__files", (("file", "string"), ("rows", "bigint"), *ends))


def record_ranges(spark: SparkSession, spec: TableSpec, database: str | None = None) -> None:
    """Record what the files cover; only the columns of the sort key are read."""
    ranges = ranges_of(spec)
    drop_table(spark, ranges, database)
    create_table(spark, ranges, database)
    load_table(spark, ranges, file_ranges(read_table(spark, spec, database), *spec.sort_by), database)


def read_range(
    spark: SparkSession, spec: TableSpec, column: str, low, high, database: str | None = None
) -> DataFrame:
    """Rows whose sort column is from ``low`` to ``high``, from the files that may hold such rows.

    Files written since the ranges were recorded are read as well.
    """
    if column not in spec.sort_by:
        raise ValueError(f"{column} is not in the sort key of {spec.name}")
    rows = read_table(spark, spec, database).where(F.col(column).between(low, high))
    return without_files(rows, read_table(spark, ranges_of(spec), database), column, low, high)
