"""Vector codes: every vector cut into parts, each part replaced by the nearest entry of its codebook.

All of it is done in integers, so codes and codebooks are the same on every machine and for every
partitioning. Distances come from matrix products: integers are broken into limbs so narrow that
float64 products add up below 2 ** 53, hence exactly, and the products are put together in 64-bit integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmill.llm.common import unpack
from segmill.operators.staging import stage

#: Components become floor(SCALE * x).
SCALE = 4096
#: Distinct labels up to which their sums are broadcast; beyond, rows and sums meet in a salted join.
BROADCAST_LABELS = 100_000
_SALTS = 64
#: Rows for which distances are held at once.
_ROWS = 16_384
_LIMB = 20


def _limbs(x: np.ndarray) -> list[np.ndarray]:
    """Float64 arrays that add up to ``x`` when the i-th counts 2 ** (i * _LIMB); the last one has the sign."""
    out = []
    while True:
        if -(1 << _LIMB) <= int(x.min(initial=0)) and int(x.max(initial=0)) < 1 << _LIMB:
            return [*out, x.astype(np.float64)]
        out.append((x & ((1 << _LIMB) - 1)).astype(np.float64))
        x = x >> _LIMB


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b.T`` of 64-bit integers, exact where the result itself fits 64 bits.

    A product of limbs is below 2 ** 40 and up to 4,096 of them are added at once, below 2 ** 53.
    What the limbs leave above 64 bits wraps around and cancels out.
    """
    total = np.zeros((len(a), len(b)), np.int64)
    for start in range(0, a.shape[1], 4096):
        left, right = _limbs(a[:, start : start + 4096]), _limbs(b[:, start : start + 4096])
        for i, x in enumerate(left):
            for j, y in enumerate(right):
                if (shift := (i + j) * _LIMB) < 64:
                    total += (x @ y.T).astype(np.int64) << shift
    return total


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of ``x`` the first nearest row of ``entries``, and the squared distance."""
    largest = max(abs(int(v)) for part in (x, entries) for v in (part.min(initial=0), part.max(initial=0)))
    if 4 * largest * largest * x.shape[1] < 1 << 63:
        # |x|^2 is the same for all entries: it does not decide which is nearest.
        far = (entries * entries).sum(1) - 2 * products(x, entries)
        first = far.argmin(1)
        return first, far[np.arange(len(x)), first] + (x * x).sum(1)
    whole = [((x.astype(object) - e) ** 2).sum(1) for e in entries.astype(object)]  # integers of any size
    rows = [min((d, i) for i, d in enumerate(row)) for row in zip(*whole)]
    return np.array([i for _, i in rows]), np.array([d for d, _ in rows], object)


@dataclass(frozen=True)
class Codebooks:
    """``entries[part][entry]`` is a list of integers; no entries if there were no vectors."""

    entries: list[list[list[int]]]

    @property
    def sha256(self) -> str:
        numbers = [str(x) for part in self.entries for entry in part for x in entry]
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()

    def arrays(self) -> list[np.ndarray]:
        return [np.array(part, np.int64) for part in self.entries]


def whole_vectors(df: DataFrame, vector: str) -> DataFrame:
    """The rows whose vector is there and holds finite numbers only."""
    x = F.col(f"`{vector}`").cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return df.where(x.isNotNull() & finite)


def _integers(column: pa.Array, scale: int, parts: int, dims: int) -> Iterator[np.ndarray]:
    """Blocks of rows of integers (rows x parts x components)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths != dims).any():
        raise ValueError(f"vectors of {sorted(set(lengths.tolist()) | {dims})} components: all must have the same number")
    scaled = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale).reshape(-1, parts, dims // parts)
    if scaled.size and np.abs(scaled).max() >= 2.0**62:
        raise ValueError(f"a component times {scale} is 2 ** 62 or more")
    for start in range(0, len(scaled), _ROWS):
        yield scaled[start : start + _ROWS].astype(np.int64)


def fit(
    df: DataFrame, id_column: str = "vec_id", vector: str = "embedding", parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = SCALE
) -> Codebooks:
    """Codebooks of ``entries`` integer vectors for each of ``parts`` equal consecutive parts.

    They start as the vectors of the smallest ids (fewer if there are fewer; null ids last, equal ids in order of
    their vectors). Each round assigns every part to its nearest entry, of equal ones the first, and
    replaces an entry by the floor of the mean of its parts, if it has any. Rows with a null vector or with null or
    non-finite components do not count; repeated rows count each. Vectors of unequal length, or of one that
    ``parts`` does not divide, are an error. Each round is one pass that sends ``parts * entries`` rows of sums per task.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a part's code has two hex digits: 1 to 256 entries")
    rows = whole_vectors(df, vector).select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    first = rows.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()
    if not first:
        return Codebooks([])
    dims = len(first[0].v)
    if dims % parts or not dims:
        raise ValueError(f"vectors of {dims} components do not give {parts} equal parts")
    blocks = list(_integers(pa.array([r.v for r in first], pa.list_(pa.float64())), scale, parts, dims))
    books = Codebooks(np.concatenate(blocks).transpose(1, 0, 2).tolist())
    vectors = rows.select("v")
    schema = "part int, entry int, n long, sums array<decimal(38,0)>"
    for _ in range(rounds):
        held = books

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            books = held.arrays()
            count = np.zeros((parts, entries), np.int64)
            total = np.zeros((parts, entries, dims // parts), object)
            for batch in batches:
                for x in _integers(batch.column(0), scale, parts, dims):
                    for p, book in enumerate(books):
                        which, _ = nearest(x[:, p], book)
                        count[p] += np.bincount(which, minlength=entries)
                        for e in np.unique(which):
                            part = x[which == e, p]
                            exact = np.abs(part).max() < 1 << 48  # a block's sum then fits 64 bits
                            total[p, e] += part.sum(0) if exact else part.astype(object).sum(0)
            used = [(p, e) for p in range(parts) for e in range(entries) if count[p, e]]
            yield pa.RecordBatch.from_arrays([
                pa.array([p for p, _ in used], pa.int32()), pa.array([e for _, e in used], pa.int32()), pa.array([int(count[u]) for u in used], pa.int64()),
                pa.array([[Decimal(int(s)) for s in total[u]] for u in used], pa.list_(pa.decimal128(38, 0))),
            ], names=["part", "entry", "n", "sums"])

        totals = vectors.mapInArrow(sums, schema).groupBy("part", "entry").agg(
            F.sum("n").alias("n"), *[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(dims // parts)]
        )
        new = [[list(e) for e in part] for part in books.entries]
        for r in totals.collect():  # parts * entries rows
            new[r.part][r.entry] = [int(r[f"s{i}"]) // r.n for i in range(dims // parts)]
        books = Codebooks(new)
    return books


def encode(
    df: DataFrame, books: Codebooks, vector: str = "embedding", parts: int = 8, scale: int = SCALE, keep: Sequence[str] | None = None
) -> DataFrame:
    """``df`` without the rows that ``fit`` leaves out, with ``code`` and ``error``.

    ``code`` has two hex digits per part, ``error`` is the sum of the squared distances to the entries. The columns ``keep``
    (all of them by default) stay; one called ``code`` or ``error`` is replaced. Lazy, one pass, nothing is shuffled.
    """
    kept = whole_vectors(df, vector)
    row = F.struct(*[F.col(f"`{c}`") for c in (df.columns if keep is None else keep)]).alias("row")
    rows = kept.select(row, F.col(f"`{vector}`").cast("array<double>").alias("v"))
    schema = T.StructType([rows.schema["row"], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = books.arrays()
        dims = sum(e.shape[1] for e in entries)
        digits = np.array([f"{i:02x}" for i in range(256)], object)
        for batch in batches:
            code, error = [], []
            for x in _integers(batch.column(1), scale, parts, dims):
                found = [nearest(x[:, p], entry) for p, entry in enumerate(entries)]
                code += ["".join(row) for row in digits[np.stack([which for which, _ in found], 1)].tolist()]
                error += [int(e) for e in sum(d.astype(object) for _, d in found)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(code, pa.string()), pa.array(error, pa.int64())], names=["row", "code", "error"])

    return unpack(rows.mapInArrow(codes, schema), "code", "error")


def group_sums(df: DataFrame, value: str, group: str, result: str, salt: Sequence[Column]) -> DataFrame:
    """``df`` with the sum of ``value`` over the rows of an equal ``group``, nulls being equal.

    Sums are combined within tasks. Up to ``BROADCAST_LABELS`` groups they are broadcast; beyond, every
    sum is repeated for each salt, so that rows of one group are spread by ``salt`` over many tasks. ``df`` is read three times: stage it.
    """
    sums = df.groupBy(F.col(f"`{group}`").alias("__group")).agg(F.sum(f"`{value}`").alias("__sum"))
    same = F.col(f"`{group}`").eqNullSafe(F.col("__group"))
    if sums.limit(BROADCAST_LABELS + 1).count() <= BROADCAST_LABELS:
        joined = df.join(F.broadcast(sums), same)
    else:
        salted = sums.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
        rows = df.withColumn("__salt", F.pmod(F.xxhash64(*salt), F.lit(_SALTS)).cast("int"))
        joined = rows.join(salted, same & (F.col("__salt") == F.col("__copy"))).drop("__salt", "__copy")
    return joined.withColumn(result, F.col("__sum")).drop("__group", "__sum")


def compress(df: DataFrame, label: str = "label", id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Codebooks of ``df``, and its rows (those that ``fit`` counts) with ``code, error, label_error, codebooks_sha256``.

    ``label_error`` is the error summed over all rows of an equal label, null labels together. The
    result reads a staged table without the vectors. An empty table gives an empty result.
    """
    books = fit(df, id_column, vector)
    keep = [c for c in df.columns if c.lower() not in ("label_error", "codebooks_sha256", vector.lower())]
    coded = stage(encode(df, books, vector, keep=keep), "codes")
    summed = group_sums(coded, "error", label, "label_error", [F.col(f"`{id_column}`"), F.col("code")])
    return summed.withColumn("codebooks_sha256", F.lit(books.sha256))
