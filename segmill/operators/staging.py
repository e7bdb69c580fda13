"""Tables written half-way, so that later passes do not repeat the work before them.

A staged table lives in shared storage: tasks that are lost with their executor
re-read it instead of re-running the plan behind it, and sampling from it gives
the same rows every time.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable
from contextvars import ContextVar
from functools import wraps
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_shared: set[tuple[str, str]] = set()  # applications and folders that a trial found to be shared
_open: ContextVar[Scope | None] = ContextVar("scope", default=None)


def _check_shared(spark: SparkSession, root: str) -> None:
    """An error unless rows that tasks write below ``root`` are all found by the driver, and by tasks that read them.

    Where a folder is local to each machine, Spark's commit leaves an empty table without an error. A good outcome
    is kept for the application; it tells of the executors that were there, not of later ones.
    """
    refused = f"{root} is local to each machine: name its scheme, file: too if the folder is shared"
    try:
        application = spark.sparkContext.applicationId
        if (application, root) in _shared:
            return
        rows, path = 2 * spark.sparkContext.defaultParallelism, f"{root}/shared-{uuid.uuid4().hex}"
        spark.range(0, rows, 1, rows).write.parquet(path)
        try:
            found = spark.read.schema("id long").parquet(path).agg(F.count_distinct("id")).first()[0]
        finally:
            _delete(spark, path)
    except Exception as error:
        raise ValueError(refused) from error
    if found != rows:
        raise ValueError(refused)
    _shared.add((application, root))


def staging_root(spark: SparkSession) -> str:
    """The folder the session names in ``spark.checkpoint.dir``.

    Only a local session without one gets a temporary folder; on a cluster, where
    executors share no local disk, its absence is an error. So is a path without a scheme that
    would be on the machines' own disks, unless a trial shows that all share it.
    """
    local = re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master)
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        if not local and "://" not in root and not root.startswith("file:"):
            # Without a scheme the path is that of the cluster's default file system.
            scheme = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
            if scheme.startswith("file:"):
                _check_shared(spark, root.rstrip("/"))
        return root.rstrip("/")
    if not local:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="segmill-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def staging_path(spark: SparkSession, name: str) -> str:
    """A path below the staging root that nothing else uses. It belongs to the innermost open ``Scope``."""
    path = f"{staging_root(spark)}/{name}-{uuid.uuid4().hex}"
    if scope := _open.get():
        scope.paths.append((spark, path))
    return path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet below the staging root and return the written table."""
    spark = df.sparkSession
    path = staging_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def _plain(spark: SparkSession, path: str) -> str:
    """``path`` with its scheme and without escapes, as files of a table are compared with it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.makeQualified(place).toString()


class Scope:
    """Owns what is staged while it is open, and deletes it at its end, after a failure as well.

    What ``keep`` names survives a good end: the folders that those tables read then belong to the scope
    around this one, if there is one, else to the caller.
    """

    def __init__(self) -> None:
        self.paths: list[tuple[SparkSession, str]] = []
        self.kept: set[str] = set()

    def __enter__(self) -> Scope:
        self._outer = _open.set(self)
        return self

    def keep(self, *tables: DataFrame) -> None:
        for df in tables:
            # file:///a and file:/a are the same
            files = [re.sub("^file:/+", "file:/", unquote(file)) for file in df.inputFiles()]
            for spark, path in self.paths:
                if any(file.startswith(f"{_plain(spark, path)}/") for file in files):
                    self.kept.add(path)

    def __exit__(self, kind: type | None, *_: object) -> None:
        _open.reset(self._outer)
        outer = _open.get()
        for spark, path in self.paths:
            if kind is None and path in self.kept:
                if outer:
                    outer.paths.append((spark, path))
                continue
            _delete(spark, path)


def owned[**P](query: Callable[P, DataFrame]) -> Callable[P, DataFrame]:
    """``query`` in a scope of its own, which keeps what the returned table reads."""

    @wraps(query)
    def scoped(*args: P.args, **kwargs: P.kwargs) -> DataFrame:
        with Scope() as scope:
            out = query(*args, **kwargs)
            scope.keep(out)
        return out

    return scoped


def drop_staged(df: DataFrame) -> None:
    """Delete the files of a table that ``stage`` returned. Files outside the staging root are left alone."""
    spark = df.sparkSession
    root = staging_root(spark)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    base = hadoop(root)
    system = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    whole = system.makeQualified(base).toString()
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        if system.makeQualified(hadoop(folder)).toString().startswith(f"{whole}/"):
            system.delete(hadoop(folder), True)
