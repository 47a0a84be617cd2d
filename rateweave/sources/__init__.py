"""Scans and sinks: ``::`` text, Parquet, and the test-table adapter."""

from rateweave.sources.delimited import (
    accepted,
    parse_lines,
    read_delimited,
    read_lines,
    rejected,
    to_lines,
)
from rateweave.sources.parquet import convert_to_parquet, read_parquet, write_parquet
from rateweave.sources.tables import Tables, load_dat_tables, load_tables

__all__ = [
    "Tables",
    "accepted",
    "convert_to_parquet",
    "load_dat_tables",
    "load_tables",
    "parse_lines",
    "read_delimited",
    "read_lines",
    "read_parquet",
    "rejected",
    "to_lines",
    "write_parquet",
]
