"""File sinks. Each one writes a directory of part files from the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, single: bool = False) -> None:
    """CSV with a header, replacing what is at ``path``.

    ``single`` puts everything in one part file through one task; it is meant for
    tables of one row per cluster, not for labelled rows.
    """
    out = df.coalesce(1) if single else df
    out.write.mode("overwrite").option("header", True).csv(path)


def write_document(df: DataFrame, path: str) -> None:
    """A one-row table as one JSON document, null fields included."""
    df.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def to_json_rows(df: DataFrame) -> DataFrame:
    """Each row as a JSON object in the column ``value``; null fields are left out."""
    return df.select(F.to_json(F.struct("*")).alias("value"))


def write_json_rows(df: DataFrame, path: str) -> None:
    """JSON lines, replacing what is at ``path``."""
    to_json_rows(df).write.mode("overwrite").text(path)
