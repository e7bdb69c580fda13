"""A bounded, repeatable sample of labelled documents to fit a classifier on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmill.llm.common import bounded_batches, held_out

_SCALE = 1 << 40


def training_texts(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """``doc_id``, ``text`` and ``label`` of at most ``most`` labelled documents that are not held out.

    The ids are chosen by hash: those below a threshold that lets through a little more
    than ``most``, then the ``most`` smallest hashes of these. So the sample is the same
    every time, nothing but ids is sorted, and the list of ids that is broadcast has at most
    ``most`` rows of two numbers. Labels other than 0 and 1 and null ids are left out; an
    id labelled more than once gets the majority's label, 1 if they are even.
    """
    bounded_batches(docs.sparkSession)
    known = (
        labels.select(labels["doc_id"], labels[label].cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    )
    place = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(_SCALE))
    share = min(1.0, 1.1 * most / max(known.count(), 1) + 1e-9)
    chosen = known.where(place < int(share * _SCALE) + 1).orderBy(place, "doc_id").limit(most)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
