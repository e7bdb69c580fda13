"""Projections: names to text, training columns, alignment to a recorded schema, JSON-safe rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmill.functions.columns import as_double, named
from segmill.functions.jsonsafe import json_safe_value
from segmill.functions.names import name_columns

NAME_COLUMN = "product_name"
# Columns that results add.
RESULT_COLUMNS = ("prediction", "n", "features", "features_raw")


def plain_results(df: DataFrame) -> DataFrame:
    """``df`` with underscores after columns that are called like one of a result, until the name is free."""
    names, renamed = {c.lower() for c in df.columns}, {}
    for c in df.columns:
        if c.lower() in RESULT_COLUMNS:
            free = f"{c}_"
            while free.lower() in names:
                free += "_"
            names.add(free.lower())
            renamed[c] = free
    return df.withColumnsRenamed(renamed) if renamed else df


def flatten_names(df: DataFrame, column: str = NAME_COLUMN, keep: Sequence[str] = ()) -> DataFrame:
    """The columns in ``keep``, then the text columns that ``column`` flattens to."""
    texts = [expr.alias(name) for name, expr in name_columns(df.schema, column).items()]
    return df.select(*[named(c) for c in keep], *texts)


def training_columns(df: DataFrame, features: Sequence[str], name_column: str = NAME_COLUMN) -> DataFrame:
    """Flattened name texts and the features as doubles: the row that training works on."""
    texts = name_columns(df.schema, name_column)
    clash = sorted(set(texts) & set(features))
    if clash:
        raise ValueError(f"columns would be both text and feature: {', '.join(clash)}")
    return df.select(
        *[expr.alias(name) for name, expr in texts.items()],
        *[as_double(named(c)).alias(c) for c in features],
    )


def align(
    df: DataFrame,
    features: Sequence[str],
    text_cols: Sequence[str] = (),
    name_column: str = NAME_COLUMN,
    on_bad: str = "error",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Bring ``df`` to a recorded schema: ``keep``, then ``text_cols``, then ``features``.

    Recorded columns that ``df`` lacks become typed nulls, columns not recorded are
    dropped, and features are cast to double.
    """
    texts = name_columns(df.schema, name_column)
    present = set(df.columns)
    null = F.lit(None)
    return df.select(
        *[named(c) for c in keep],
        *[texts.get(c, null.cast("string")).alias(c) for c in text_cols],
        *[(as_double(named(c), on_bad) if c in present else null.cast("double")).alias(c) for c in features],
    )


def json_safe(df: DataFrame) -> DataFrame:
    """Same columns, with values JSON can carry (see ``json_safe_value``)."""
    return df.select(*[json_safe_value(named(f.name), f.dataType).alias(f.name) for f in df.schema.fields])
