"""Operators: table lifecycle and loads, sinks, and the layer transforms."""

from strata.operators.sinks import ExportResult, export_csv, guarded_export, write_dataset
from strata.operators.tables import (append_load, clear_table, create_if_absent, drop_if_exists,
                                     full_refresh_load, has_rows, row_count_gate, table_exists)
from strata.operators.transforms import (classified_review, movie_analytics, review_logs,
                                         user_purchase)

__all__ = [
    "ExportResult", "append_load", "classified_review", "clear_table", "create_if_absent",
    "drop_if_exists", "export_csv", "full_refresh_load", "guarded_export", "has_rows",
    "movie_analytics", "review_logs", "row_count_gate", "table_exists", "user_purchase",
    "write_dataset",
]
