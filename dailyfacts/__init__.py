"""Daily fact and dimension analytics on Spark DataFrames.

The package reads raw daily files, models them with built-in column expressions,
writes month-partitioned Parquet, loads a star schema of catalog tables behind
quality gates and answers day-by-day questions across the two facts.
"""
