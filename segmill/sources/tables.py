"""Table scans. All of them are lazy and leave pruning and pushdown to Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

#: Name of the text of a bad line beside the parsed fields; longer than any name that a schema is likely to have.
_BAD = "__line_that_is_not_of_the_schema"


def read_table(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """A parquet table; a given ``schema`` saves Spark the look into the file footers."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_json_rows(spark: SparkSession, path: str, schema: StructType | str, on_bad: str = "error") -> DataFrame:
    """One JSON object per line.

    The schema is required: inference costs a pass over the data, drops columns
    that are null throughout and reads a NaN as text. A malformed line is an error, or, with ``on_bad="null"``, a row of nulls.
    """
    if on_bad not in ("error", "null"):
        raise ValueError(f"on_bad must be 'error' or 'null', not {on_bad!r}")
    mode = "FAILFAST" if on_bad == "error" else "PERMISSIVE"
    return spark.read.schema(schema).option("mode", mode).json(path)


def read_json_quarantine(spark: SparkSession, path: str, schema: StructType | str) -> tuple[DataFrame, DataFrame]:
    """The good rows of a file of JSON objects, one per line, and the bad lines.

    A line is bad if it is no JSON object or a value is not of its field's type: it then appears in the second table
    as it is (``value``) with its ``file``, and none of it in the first. Missing fields are null and others are
    ignored; lines without text are no rows. Both tables are lazy and each is one pass over the lines.
    """
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}
    lines = spark.read.text(path).where(F.trim("value") != "")
    parsed = lines.select("value", F.col("_metadata.file_path").alias("file"), F.from_json("value", StructType([*fields.fields]).add(_BAD, StringType()), options).alias("row"))
    bad = F.col("row").isNull() | F.col("row").getField(_BAD).isNotNull()
    good = parsed.where(~bad).select(*[F.col("row").getField(f.name).alias(f.name) for f in fields.fields])
    return good, parsed.where(bad).select("file", "value")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of text files, in the column ``value``."""
    return spark.read.text(path)
