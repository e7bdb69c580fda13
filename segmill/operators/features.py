"""Choice of the feature columns: by type, by fill ratio, by variance."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmill.functions.columns import named

# Columns per aggregate. One aggregate over many more columns than this leaves
# whole-stage code generation; parquet reads each column once either way.
STATS_COLUMNS = 24


def numeric_columns(schema: T.StructType) -> list[str]:
    """Names of the top-level numeric columns, in schema order."""
    return [f.name for f in schema.fields if isinstance(f.dataType, T.NumericType)]


def _stats_chunk(df: DataFrame, columns: list[str], offset: int) -> DataFrame:
    measures = [F.count("*").alias("rows")]
    for i, c in enumerate(columns):
        measures += [F.count(named(c)).alias(f"filled_{i}"), F.stddev_samp(named(c)).alias(f"stddev_{i}")]
    per_column = [
        F.struct(
            F.lit(offset + i).alias("position"),
            F.lit(c).alias("column"),
            F.col("rows"),
            F.col(f"filled_{i}").alias("filled"),
            (F.col(f"filled_{i}") / F.when(F.col("rows") > 0, F.col("rows"))).alias("fill_ratio"),
            F.col(f"stddev_{i}").alias("stddev"),
        )
        for i, c in enumerate(columns)
    ]
    return df.agg(*measures).select(F.inline(F.array(*per_column)))


def column_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """Row count, filled (non-null) count, fill ratio and sample deviation per column.

    Everything comes from one aggregate per ``STATS_COLUMNS`` columns, each of which
    scans only its own columns and shuffles one row per task. NaN counts as filled.
    """
    if not columns:
        raise ValueError("no numeric columns in the input table")
    chunks = [columns[i : i + STATS_COLUMNS] for i in range(0, len(columns), STATS_COLUMNS)]
    frames = [_stats_chunk(df, chunk, i * STATS_COLUMNS) for i, chunk in enumerate(chunks)]
    return reduce(DataFrame.unionByName, frames)


def varies() -> Column:
    """True for a row of ``column_stats`` whose deviation is a number above zero.

    Spark sorts NaN above all numbers, so NaN (from NaN or infinite values) has to
    be ruled out by name.
    """
    return F.coalesce((F.col("stddev") > 0) & ~F.isnan("stddev"), F.lit(False))


def usable_features(stats: DataFrame, min_fill: float = 0.9) -> DataFrame:
    """The rows of ``column_stats`` that make features: filled well enough, and varying."""
    return stats.where((F.col("fill_ratio") >= min_fill) & varies())


def choose_features(df: DataFrame, min_fill: float = 0.9) -> tuple[list[str], int]:
    """The feature names in schema order, and the number of rows, from one pass over ``df``."""
    stats = column_stats(df, numeric_columns(df.schema)).collect()  # one row per column
    stats.sort(key=lambda s: s.position)
    rows = stats[0].rows
    if rows == 0:
        raise ValueError("the input table is empty")
    filled = [s for s in stats if s.fill_ratio >= min_fill]
    if not filled:
        raise ValueError(f"no numeric column is filled in at least {min_fill:g} of the rows")
    features = [s.column for s in filled if s.stddev is not None and not math.isnan(s.stddev) and s.stddev > 0]
    if not features:
        raise ValueError("no numeric feature column is left: all of them are constant or hold non-finite values")
    return features, rows
