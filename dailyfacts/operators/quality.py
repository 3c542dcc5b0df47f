"""Data-quality rules and the gate that stops a reload."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dailyfacts.operators.filters import any_null, any_of
from dailyfacts.schemas import TableSpec


class QualityError(ValueError):
    """A check gave another value than the expected one."""


@dataclass(frozen=True)
class Rule:
    """The number of rows for which ``bad`` is true must be ``expected``."""

    name: str
    bad: Column
    expected: int = 0


@dataclass(frozen=True)
class CheckResult:
    rule: str
    actual: int
    expected: int

    @property
    def passed(self) -> bool:
        return self.actual == self.expected


def null_rule(columns: Sequence[str]) -> Rule:
    return Rule(" or ".join(f"{name} is null" for name in columns), any_null(columns))


def _counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    # The filter changes no count. It lets the scan skip row groups that the
    # statistics clear of all rules, which for null rules is most of a clean table.
    suspects = df.where(any_of(rule.bad for rule in rules))
    return suspects.agg(*[F.count_if(rule.bad).alias(f"_{i}") for i, rule in enumerate(rules)])


def rule_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``rule, bad_rows`` for all rules, from one pass over the table."""
    lines = [
        F.struct(F.lit(rule.name).alias("rule"), F.col(f"_{i}").alias("bad_rows"))
        for i, rule in enumerate(rules)
    ]
    return _counts(df, rules).select(F.inline(F.array(*lines)))


def check_rules(df: DataFrame, rules: Sequence[Rule]) -> list[CheckResult]:
    """Evaluate all rules of a table in one pass; only the counts reach the driver."""
    row = _counts(df, rules).first()
    return [CheckResult(rule.name, row[i], rule.expected) for i, rule in enumerate(rules)]


def enforce(table: str, results: Sequence[CheckResult]) -> None:
    failed = [f"{r.rule}: {r.actual} not matching {r.expected}" for r in results if not r.passed]
    if failed:
        raise QualityError(f"{table}: " + "; ".join(failed))


def gate(df: DataFrame, spec: TableSpec) -> list[CheckResult]:
    """Check the gate columns of a loaded table and raise when one is null."""
    results = check_rules(df, [null_rule(spec.gate)])
    enforce(spec.name, results)
    return results


def expect_scalar(spark: SparkSession, statement: str, expected, **tables: DataFrame):
    """Run a statement and compare the first cell with the expected value."""
    row = spark.sql(statement, **tables).first()
    if row is None:
        raise QualityError(f"no row from: {statement}")
    if row[0] != expected:
        raise QualityError(f"{row[0]} not matching {expected}: {statement}")
    return row[0]
