"""Column expressions; nothing here starts a job."""

from segmill.functions.columns import as_double, named
from segmill.functions.jsonsafe import json_safe_value
from segmill.functions.names import name_columns
from segmill.functions.words import words

__all__ = ["as_double", "json_safe_value", "name_columns", "named", "words"]
