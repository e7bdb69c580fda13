"""Writers: CSV, JSON documents and rows, model bundles, published result tables."""

from segmill.sinks.bundle import save_bundle
from segmill.sinks.files import to_json_rows, write_csv, write_document, write_json_rows
from segmill.sinks.results import publish_results, read_published

__all__ = [
    "publish_results",
    "read_published",
    "save_bundle",
    "to_json_rows",
    "write_csv",
    "write_document",
    "write_json_rows",
]
