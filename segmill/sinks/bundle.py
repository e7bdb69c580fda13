"""Saving of model bundles."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from segmill.operators import commits
from segmill.sinks.files import write_document
from segmill.sources.bundle import IMPUTER_DIR, INFO_DOCUMENT, KMEANS_DIR, LOG, SCALER_DIR, VERSIONS, Bundle


def save_bundle(spark: SparkSession, bundle: Bundle, root: str) -> str:
    """Save under ``root`` and return the folder of this version.

    Every save goes to a folder of its own and is entered in the numbered log of versions only when it
    is whole. Readers take the last entry, so they see the earlier bundle until then, and
    also after a save that died half-way. Of several savers the one that commits last wins, whatever their clocks say.
    """
    version = uuid.uuid4().hex
    folder = f"{root.rstrip('/')}/{VERSIONS}/{version}"
    bundle.kmeans.write().save(f"{folder}/{KMEANS_DIR}")
    bundle.imputer.write().save(f"{folder}/{IMPUTER_DIR}")
    bundle.scaler.write().save(f"{folder}/{SCALER_DIR}")
    write_document(bundle.info(spark, folder), f"{folder}/{INFO_DOCUMENT}")
    commits.append(spark, f"{root.rstrip('/')}/{LOG}", {"version": version})
    return folder
