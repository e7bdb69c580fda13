"""Values that survive a trip through JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ISO 8601 text, with microseconds only where there are any.
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

_CHANGED = (T.DecimalType, T.FloatType, T.DoubleType, T.TimestampType, T.TimestampNTZType, T.DateType)


def _needs_change(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return any(_needs_change(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _needs_change(dtype.elementType)
    if isinstance(dtype, T.MapType):
        return _needs_change(dtype.valueType)
    return isinstance(dtype, _CHANGED)


def json_safe_value(value: Column, dtype: T.DataType) -> Column:
    """``value`` with decimals as doubles, times as ISO text and non-finite numbers as null.

    Structs, arrays and map values are treated at every depth; whatever holds
    none of these types is passed on untouched.
    """
    if not _needs_change(dtype):
        return value
    if isinstance(dtype, T.DecimalType):
        return value.cast("double")
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)
    if isinstance(dtype, T.DateType):
        return value.cast("string")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        whole = F.date_format(value, "SSSSSS") == "000000"
        return F.when(whole, F.date_format(value, ISO_SECONDS)).otherwise(F.date_format(value, ISO_MICROS))
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda item: json_safe_value(item, dtype.elementType))
    if isinstance(dtype, T.MapType):
        return F.transform_values(value, lambda _, item: json_safe_value(item, dtype.valueType))
    fields = [json_safe_value(value.getField(f.name), f.dataType).alias(f.name) for f in dtype.fields]
    return F.when(value.isNotNull(), F.struct(*fields))
