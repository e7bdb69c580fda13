"""Small helpers shared by the operators: packed rows, words, hashes."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from segmill.operators.staging import drop_staged, stage

#: The columns of a row that an operator only hands through travel in one struct of
#: this name, so that no column of the caller can clash with one of the operator.
ROW = "row"

#: Odd multiplier and mixing constants of the splitmix64 generator (fixed values).
MIX_A = np.uint64(0xBF58476D1CE4E5B9)
MIX_B = np.uint64(0x94D049BB133111EB)
GOLDEN = np.uint64(0x9E3779B97F4A7C15)

WORD = re.compile(r"\w+")


def pack(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` as one struct column ``row`` beside the given columns.

    A null struct field stays null; a table without columns cannot be packed.
    """
    row = F.struct(*[df[f"`{c}`"] for c in df.columns]).alias(ROW)
    return df.select(row, *[value.alias(name) for name, value in columns.items()])


def unpack(df: DataFrame, *results: str) -> DataFrame:
    """The packed columns and ``results``; a result replaces a packed column of its name."""
    taken = {name.lower() for name in results}
    fields = [f.name for f in df.schema[ROW].dataType.fields if f.name.lower() not in taken]
    return df.select(*[F.col(ROW).getField(f).alias(f) for f in fields], *results)


#: Rows that a Python worker gets at once. Spark's default of 10,000 whole texts of up to
#: 100,000 characters would be a GB.
BATCH_ROWS = 1000
_BATCHES = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches from Spark's default to ``BATCH_ROWS``; a number that the caller set stays."""
    if spark.conf.get(_BATCHES) == "10000":
        spark.conf.set(_BATCHES, str(BATCH_ROWS))


class Scratch:
    """Staged tables of one operator that its result does not read; ``drop`` deletes them."""

    def __init__(self) -> None:
        self.tables: list[DataFrame] = []

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        self.tables.append(stage(df, name))
        return self.tables[-1]

    def drop(self) -> None:
        while self.tables:
            drop_staged(self.tables.pop())


def words(text: str | None) -> list[str]:
    """Lower-case words of a text; a null text has none."""
    return WORD.findall(text.lower()) if text else []


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread the bits of each 64-bit number (splitmix64's finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


def unit(x: np.ndarray) -> np.ndarray:
    """64-bit numbers as doubles in [0, 1)."""
    return (x >> np.uint64(11)).astype(np.float64) * (1.0 / (1 << 53))


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves the remainder 2 by 4; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2
