"""Published results: four tables per training run, of which readers see the latest whole run.

Every publication writes to a folder of its own, never into one that is there, and is entered
in a numbered log after its last result table is written. One that dies half-way stays invisible; one under
an id that was used before replaces the earlier one for readers in one step, when its entry appears.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segmill.operators import commits
from segmill.operators.project import json_safe

# The result tables.
RESULT_TABLES = ("cluster_profiles", "cluster_centers", "training_metrics", "model_info")

_LOG = "published_log"
_LOG_SCHEMA = "run_id string, folder string"
_RUN_FORMAT = "%Y%m%dT%H%M%S%fZ"


def publish_results(
    spark: SparkSession,
    root: str,
    profiles: DataFrame,
    centers: DataFrame,
    metrics: DataFrame,
    info: DataFrame,
    run_id: str | None = None,
) -> str:
    """Publish one run and return its id, by default a UTC time stamp. The run published last is the latest, whatever its id.

    An id may be used again: its readers then get the tables of the later publication. The four tables have a row
    per cluster or one row; each goes through one task.
    """
    root = root.rstrip("/")
    run_id = run_id or datetime.now(timezone.utc).strftime(_RUN_FORMAT)
    folder = f"{run_id}/{uuid.uuid4().hex}"
    for name, table in zip(RESULT_TABLES, (profiles, centers, metrics, info), strict=True):
        stamped = json_safe(table).withColumn("run_id", F.lit(run_id))
        stamped.coalesce(1).write.mode("error").parquet(f"{root}/{folder}/{name}")
    commits.append(spark, f"{root}/{_LOG}", {"run_id": run_id, "folder": folder})
    return run_id


def read_published(spark: SparkSession, root: str, table: str, run_id: str | None = None) -> DataFrame:
    """A result table of the latest publication under the given run id, or of the latest of all; none is an error."""
    if table not in RESULT_TABLES:
        raise ValueError(f"no such result table: {table!r}")
    root = root.rstrip("/")
    log = commits.entries(spark, f"{root}/{_LOG}", _LOG_SCHEMA)
    if run_id is not None:
        log = log.where(F.col("run_id") == run_id)
    folder = log.agg(F.max_by("folder", "entry")).first()[0]
    if folder is None:
        raise ValueError(f"nothing published in {root}" + (f" as {run_id}" if run_id is not None else ""))
    return spark.read.parquet(f"{root}/{folder}/{table}")
