"""Readers: parquet tables, JSON rows (bad lines apart, if asked for), text lines, model bundles."""

from segmill.sources.bundle import Bundle, load_bundle
from segmill.sources.tables import read_json_quarantine, read_json_rows, read_lines, read_table

__all__ = ["Bundle", "load_bundle", "read_json_quarantine", "read_json_rows", "read_lines", "read_table"]
