"""Readers: parquet tables, SQL results, JDBC, typed CSV, series, inline rows."""

from .delimited import read_csv_checked, read_csv_typed
from .generated import inline_table, series
from .tables import conform, read_jdbc, read_query, read_table, register_views

__all__ = [
    "conform", "inline_table", "read_csv_checked", "read_csv_typed", "read_jdbc", "read_query",
    "read_table", "register_views", "series",
]
