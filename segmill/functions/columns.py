"""Small helpers for addressing and casting columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def named(name: str) -> Column:
    """The top-level column called ``name``, even when the name holds a dot or a backtick."""
    return F.col("`" + name.replace("`", "``") + "`")


def as_double(column: Column, on_bad: str = "error") -> Column:
    """Cast to double; text that is not a number raises, or gives null with ``on_bad="null"``."""
    if on_bad == "error":
        return column.cast("double")
    if on_bad == "null":
        return column.try_cast("double")
    raise ValueError(f"on_bad must be 'error' or 'null', not {on_bad!r}")
