"""Table segmentation as Spark jobs: prepare, cluster, describe, publish, label."""

__version__ = "0.1.0"
