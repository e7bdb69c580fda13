"""Word counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmill.functions.columns import named
from segmill.functions.words import words


def word_count(df: DataFrame, column: str = "value") -> DataFrame:
    """How often each word occurs in a text column, in code point order of the words.

    Words are counted within each task before the shuffle, so a frequent word costs
    one row per task.
    """
    each = df.select(F.explode(words(named(column))).alias("word"))
    return each.groupBy("word").agg(F.count("*").alias("count")).orderBy("word")
