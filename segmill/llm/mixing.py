"""Mix sources to target weights by nested hash thresholds, without sorting a row.

Every document gets a 64-bit hash and, for documents equal in all that is hashed, a
second one of its row number. Sizes are summed by source and leading hash digit; the
running sum shows the digit at which a source's budget ends. Only that bucket is looked
at again by its next digit, until the bucket holds one document. What lies below the
threshold is taken: a plain comparison per row.

Only DataFrame functions are used. The sums per source and digit are combined within
each task first, and the bucket refined is a 256th of its source, so a source that holds
most rows is no burden; the last join spreads every source over ``SALTS`` keys unless the
table of sources is small enough to be broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segmill.llm.common import ROW, pack, unpack
from segmill.operators.staging import stage

#: Shares of the sources in order, repeating.
WEIGHTS = (5, 2, 1)
#: A document is taken this many times at most.
MAX_REPEATS = 3
#: Up to this many sources (a few hundred bytes each), their thresholds are broadcast.
BROADCAST_SOURCES = 10_000
SALTS = 64

_WORD = r"[^\x20\x09-\x0D]+"
_LEVELS = 16
_KEY = ["no_source", "source_key"]


def size_of(text: Column) -> Column:
    """Words between ASCII white space; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)).cast("long"), F.lit(0).cast("long"))


def _digit(level: int) -> Column:
    """The ``level``-th byte of the pair of hashes; the sign bit is flipped, so the order is that of signed numbers."""
    number = F.col("hash_a" if level < 8 else "hash_b")
    digit = F.shiftrightunsigned(number, 56 - 8 * (level % 8)).bitwiseAND(F.lit(255))
    return (digit.bitwiseXOR(F.lit(128)) if level % 8 == 0 else digit).cast("int")


def targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Adds ``target`` to one row per source (``no_source``, ``source_key``, ``source_size``).

    Sources share the total by their weights; no target exceeds ``max_repeats`` times its
    source, and what is left over goes to the others by weight. That is the level L at
    which ``sum(least(max_repeats * size, L * weight))`` is the total: with the sources in
    order of ``max_repeats * size / weight``, the first one that L does not fill decides it.
    Runs over one row per source, in one task.
    """
    ranked = sources.withColumn("rank", F.row_number().over(Window.orderBy(*_KEY)) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    everything = Window.partitionBy()
    before = Window.orderBy("full_at", *_KEY).rowsBetween(Window.unboundedPreceding, -1)
    level = (F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    return (
        ranked.withColumn("weight", weight)
        .withColumn("most", F.col("source_size") * float(max_repeats))
        .withColumn("full_at", F.col("most") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything).cast("double"))
        .withColumn("level", level)
        .withColumn("level", F.min_by("level", F.when(F.col("level") <= F.col("full_at"), F.col("full_at"))).over(everything))
        .select(*_KEY, "source_size", F.coalesce(F.least("most", F.col("level") * F.col("weight")), F.lit(0.0)).alias("target"))
    )


def _thresholds(rows: DataFrame, goals: DataFrame) -> DataFrame:
    """Per source, the whole repeats and the hashes (``edge_a``, ``edge_b``) below which one more copy is taken.

    ``edge_b`` is null if the edge lies between two values of ``hash_a``.
    """
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    goals = goals.withColumn("repeats", whole)
    state = stage(goals.withColumn("rest", F.col("target") - F.col("repeats") * F.col("source_size")), "mix-goals")
    active, known = rows, None
    for level in range(_LEVELS):
        sums = active.groupBy(*_KEY, _digit(level).alias("digit")).agg(F.sum("size").alias("held"), F.count("*").alias("n"))
        upto = Window.partitionBy(*_KEY).orderBy("digit")
        budget = state.select(*_KEY, "rest") if known is None else known.select(*_KEY, "rest")
        edge = (
            sums.withColumn("upto", F.sum("held").over(upto))
            .join(budget, _KEY)
            .where(F.col("upto") > F.col("rest"))
            .groupBy(*_KEY)
            .agg(F.min_by(F.struct("digit", "n", "held", (F.col("rest") - F.col("upto") + F.col("held")).alias("rest")), "digit").alias("e"))
            .select(*_KEY, "e.*")
        )
        known = stage(edge, "mix-edge")
        widest = known.agg(F.max("n")).first()[0]
        inside = active.withColumn("digit", _digit(level)).join(known.select(*_KEY, "digit"), [*_KEY, "digit"]).drop("digit")
        if widest is None or widest <= 1 or level == _LEVELS - 1:
            last = inside.select(*_KEY, "hash_a", "hash_b", "size").join(known.select(*_KEY, "rest"), _KEY)
            last = last.withColumn("closer", F.col("rest") * 2 > F.col("size"))
            return state.join(last.select(*_KEY, "hash_a", "hash_b", "closer"), _KEY, "left")
        active = stage(inside, "mix-bucket")
    raise AssertionError


def mix(
    docs: DataFrame,
    text: str = "text",
    source: str = "source",
    keep: list[str] | None = None,
    weights: tuple[float, ...] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
) -> DataFrame:
    """Size, source size, target and words taken for every document, beside its columns ``keep`` (all by default).

    Sources are ordered by code point, null last, and take ``weights`` in turn. A document
    is taken 0 to ``max_repeats`` times: all documents of a source equally often, and those
    below the source's hash threshold once more. The words taken from a source differ from
    its target by half of one document at most. The document on the threshold is taken if that comes
    nearer. Equal inputs give equal results: the choice rests on a hash of text, source
    and kept columns; rows equal in all of these are interchangeable, and the number of
    them that is taken is fixed.

    A null or empty text has size 0 and is never taken. A null source is a source. An
    empty table gives an empty one. Result columns (``size``, ``source_size``, ``target``,
    ``repeats``, ``taken``) replace kept columns of the same name.
    """
    keep = docs.columns if keep is None else keep
    hashable = [c for c in keep if not _has_map(docs.schema[c].dataType)]
    measured = pack(
        docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keep, text, source])]),
        size=size_of(docs[f"`{text}`"]),
        no_source=docs[f"`{source}`"].isNull(),
        source_key=F.coalesce(docs[f"`{source}`"].cast("string"), F.lit("")),
        hash_a=F.xxhash64(docs[f"`{text}`"], docs[f"`{source}`"], *[docs[f"`{c}`"] for c in hashable]),
        hash_b=F.xxhash64(F.monotonically_increasing_id()),
    )
    kept = F.struct(*[F.col(ROW).getField(c).alias(c) for c in keep]).alias(ROW)
    rows = stage(measured.withColumn(ROW, kept), "mix-rows")
    slim = rows.select(*_KEY, "size", "hash_a", "hash_b")
    goals = targets(slim.groupBy(*_KEY).agg(F.sum("size").alias("source_size")), weights, max_repeats)
    edges = stage(_thresholds(slim, goals), "mix-edges")
    if edges.count() <= BROADCAST_SOURCES:
        joined = rows.join(F.broadcast(edges.withColumnsRenamed({"hash_a": "edge_a", "hash_b": "edge_b"})), _KEY)
    else:
        salted = edges.withColumnsRenamed({"hash_a": "edge_a", "hash_b": "edge_b"}).withColumn(
            "salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
        )
        joined = rows.withColumn("salt", F.pmod("hash_b", F.lit(SALTS)).cast("int")).join(salted, [*_KEY, "salt"])
    below = (F.col("hash_a") < F.col("edge_a")) | ((F.col("hash_a") == F.col("edge_a")) & (F.col("hash_b") < F.col("edge_b")))
    at = (F.col("hash_a") == F.col("edge_a")) & (F.col("hash_b") == F.col("edge_b")) & F.col("closer")
    times = F.when(F.col("size") > 0, F.col("repeats") + F.coalesce(below | at, F.lit(False)).cast("long")).otherwise(0)
    result = joined.withColumn("repeats", times.cast("long")).withColumn("taken", F.col("size") * F.col("repeats"))
    return unpack(result, "size", "source_size", "target", "repeats", "taken")


def _has_map(kind) -> bool:
    return "map<" in kind.simpleString() or kind.simpleString() == "variant"
