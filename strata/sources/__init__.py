"""Readers: typed CSV, bronze CSV, catalog/JDBC tables, datasets by format."""

from strata.sources.csv import NULL_MARKER, csv_read_options, read_bronze_csv, read_csv_typed
from strata.sources.datasets import FORMATS, check_format, read_dataset
from strata.sources.tables import read_jdbc, read_table

__all__ = [
    "FORMATS", "NULL_MARKER", "check_format", "csv_read_options", "read_bronze_csv",
    "read_csv_typed", "read_dataset", "read_jdbc", "read_table",
]
