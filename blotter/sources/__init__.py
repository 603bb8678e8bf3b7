"""Readers and writers.  Schemas are explicit by default: inference costs extra
passes over the input and can type the same column differently per file."""

from blotter.sources.files import header_census, read_csv, read_delimited, read_parquet, union_files
from blotter.sources.quarantine import quarantine, read_csv_ledger
from blotter.sources.sinks import csv_to_parquet, list_tables, write_csv, write_parquet

__all__ = [
    "csv_to_parquet",
    "header_census",
    "list_tables",
    "quarantine",
    "read_csv",
    "read_csv_ledger",
    "read_delimited",
    "read_parquet",
    "union_files",
    "write_csv",
    "write_parquet",
]
