"""Catalog table reader."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dailyfacts.schemas import TableSpec


def qualified(spec: TableSpec, database: str | None = None) -> str:
    return f"`{database}`.`{spec.name}`" if database else f"`{spec.name}`"


def read_table(spark: SparkSession, spec: TableSpec, database: str | None = None) -> DataFrame:
    return spark.table(qualified(spec, database))
