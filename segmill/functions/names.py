"""Flattening of a nested name column into plain text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmill.functions.columns import named

# The separator, and the element fields of an array of names with
# the suffix of the text column each one becomes.
NAME_SEPARATOR = " | "
ARRAY_FIELDS = {"lang": "langs", "text": "texts"}


def name_columns(schema: T.StructType, column: str = "product_name") -> dict[str, Column]:
    """Text columns that stand for ``column``, by output name.

    An array of structs gives one joined text per known element field, a struct
    one text per field, anything else its text form. A schema without the column
    gives nothing.
    """
    if column not in schema.fieldNames():
        return {}
    source, dtype = named(column), schema[column].dataType

    if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType):
        present = dtype.elementType.fieldNames()
        return {
            f"{column}_{suffix}": F.concat_ws(NAME_SEPARATOR, source.getField(field).cast("array<string>"))
            for field, suffix in ARRAY_FIELDS.items()
            if field in present
        }
    if isinstance(dtype, T.StructType):
        return {f"{column}_{f}": source.getField(f).cast("string") for f in dtype.fieldNames()}
    return {column: source.cast("string")}
