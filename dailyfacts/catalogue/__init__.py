"""Registered queries: the package's operators run over the benchmark tables.

Every query is registered with the SQL that gives the same rows on another engine.
"""

from dailyfacts.catalogue import aggregates, columns, files, joins, jobs, tables
from dailyfacts.catalogue.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "aggregates", "columns", "files", "jobs", "joins", "tables"]
