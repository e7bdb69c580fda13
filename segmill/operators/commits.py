"""Numbered entries, each added by exactly one writer: the order in which runs and versions became whole.

An entry is a file of its own, created only if there is none of its number. Of two writers that want the same number
one gets it and the other takes the next, so the order is that of the commits, whatever the clocks of
the machines say. HDFS and stores with conditional writes refuse the second creation themselves, as does a local disk.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_DIGITS = 20


def _system(spark: SparkSession, path: str):
    """The file system of ``path``, and ``path`` for it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create the file with this text; False if there is one already, which is left as it is."""
    system, place = _system(spark, path)
    jvm = spark.sparkContext._jvm
    system.mkdirs(place.getParent())
    if system.getUri().getScheme() == "file":
        file = jvm.java.io.File(place.toUri().getPath())
        if not file.createNewFile():  # one step, unlike Hadoop's look and create
            return False
        stream = jvm.java.io.FileOutputStream(file)
    else:
        try:
            stream = system.create(place, False)
        except Exception:
            if system.exists(place):
                return False
            raise
    stream.write(bytearray(text.encode()))
    stream.close()
    return True


def append(spark: SparkSession, folder: str, record: dict[str, object]) -> int:
    """Add ``record`` behind all entries of ``folder`` and return its number."""
    system, place = _system(spark, folder)
    number = 0
    if system.exists(place):
        names = [status.getPath().getName().split(".")[0] for status in system.listStatus(place)]
        number = max((int(n) for n in names if n.isdigit()), default=0)
    while True:
        number += 1
        if create_once(spark, f"{folder}/{number:0{_DIGITS}d}.json", json.dumps(record)):
            return number


def entries(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """All whole records of ``folder`` with their number as ``entry``. One whose writer died before it had text does not count."""
    system, place = _system(spark, folder)
    if not system.exists(place):
        fields = T.StructType().fromDDL(schema).fields
        return spark.createDataFrame([], T.StructType([T.StructField("entry", T.LongType()), *fields]))
    number = F.split_part(F.col("_metadata.file_name"), F.lit("."), F.lit(1)).cast("long")
    table = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(folder)
    return table.select(number.alias("entry"), *table.columns)
