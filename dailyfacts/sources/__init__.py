"""Readers: a path or a table name in, a lazy DataFrame out."""

from dailyfacts.sources.documents import read_case_records
from dailyfacts.sources.files import (
    read_case_documents,
    read_csv_inferred,
    read_flight_files,
    read_json_inferred,
    read_lookup_file,
    read_model,
)
from dailyfacts.sources.tables import read_table

__all__ = [
    "read_case_documents",
    "read_case_records",
    "read_csv_inferred",
    "read_flight_files",
    "read_json_inferred",
    "read_lookup_file",
    "read_model",
    "read_table",
]
