"""Documents to training mix: five stages, each written as Parquet and read again by the next.

Every stage takes the columns of ``documents``, and any others beside them whatever they are called, and
returns them, apart from the last, which adds the sizes and how often each document is taken. In every stage a
null text counts as empty, null ids, languages and sources are values like others, texts may be of any length,
and an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segmill.llm import darts, mixing, quality, secrets, templates
from segmill.operators.staging import Scope, drop_staged, staging_path
from segmill.sources import read_table


def _shielded(docs: DataFrame, *results: str) -> tuple[DataFrame, list]:
    """``docs`` with other names for columns called like ``results``, and the columns that bring the names back."""
    other = {c: f"__kept_{i}" for i, c in enumerate(docs.columns) if c.lower() in results}
    return docs.withColumnsRenamed(other), [F.col(f"`{other.get(c, c)}`").alias(c) for c in docs.columns]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the classifier scores at the threshold or above; fitted on labels that are not held out.

    Rows with equal texts are kept or dropped together; an empty text has a score like any other.
    """
    forest = quality.fit(docs, read_table(spark, f"{sf_dir}/labels.parquet"))
    return docs.where(quality.score(docs["text"], forest) >= quality.THRESHOLD)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each class of near duplicates, and all empty ones.

    Of several rows with that id, repeated ones included, one is kept.
    """
    shielded, columns = _shielded(docs, "row_no", "class_key")
    return darts.first_of_each(darts.near_duplicates(shielded)).select(*columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a benchmark item, also with other numbers, names and units. Rows with equal texts go together."""
    return templates.without_leaks(docs, read_table(spark, f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret by ``[SECRET]`` and counts the characters anew; keeps all documents, repeated and empty ones too. A null text stays null."""
    shielded, columns = _shielded(docs, "n_assign", "n_access", "n_hex", "n_random", "base", "spans")
    found = secrets.find_secrets(shielded)
    clean = found.withColumn("text", secrets.redact(F.col("text"), F.col("spans"))).select(*columns)
    return clean.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else clean


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with ``repeats`` (how often) and ``taken`` (words in all). Null and empty texts are never taken; of equal rows it is fixed how many are."""
    return mixing.mix(docs).where("repeats > 0")


STAGES = [
    ("quality classifier", quality_classifier),
    ("near-duplicates", near_dedup),
    ("benchmark decontamination", decontamination),
    ("secret scan", secret_scan),
    ("source mixing", mixing_stage),
]

#: Classifier and signatures have no SQL form; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages on ``documents``; what lies between is written to the shared folder and deleted once the next stage is."""
    docs = read_table(spark, f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        path = staging_path(spark, f"pipeline-{number}")
        with Scope():
            stage(spark, docs, sf_dir).write.parquet(path)
        if number:
            drop_staged(docs)
        docs = read_table(spark, path)
    return docs
