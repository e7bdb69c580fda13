"""Connected components of a table of links, by minimum labels and pointer jumping."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmill.operators.staging import stage


def components(links: DataFrame, stage: Callable[[DataFrame, str], DataFrame] = stage) -> DataFrame:
    """``node`` and ``component`` (the smallest node it is connected with) for every end of the links (a, b).

    Each round gives a node the smallest label among itself and its neighbours, then that
    label's own label; it ends when no label changes, after about log2 of the longest
    chain. Every round is written to the shared folder by ``stage``. Labels reach a hub's
    neighbours through a join that Spark splits when skewed, and minima are combined in each task first.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    ends = stage(both.where("a != b").distinct(), "components-ends")
    labels = stage(ends.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("component")), "components-labels")
    while True:
        near = (
            ends.join(labels.select(F.col("node").alias("b"), "component"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("near"))
        )
        lower = labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("low"))
        lower = stage(lower, "components-lower")
        up = lower.select(F.col("node").alias("low"), F.col("low").alias("up"))
        jumped = stage(lower.join(up, "low").select("node", "old", F.least("low", "up").alias("component")), "components-labels")
        labels = jumped.select("node", "component")
        if jumped.where("component != old").isEmpty():
            return labels
