"""Nearest vectors by cosine through an inverted multi-index.

The two halves of the unit vectors are quantised apart, each by its own centroids, so K
centroids a half give K * K cells. A query walks the pairs of centroids by rising sum of
its two distances, held in a heap, until the cells visited hold a given share of all
vectors; the vectors in them are ranked anew by their exact cosine.

How large that share must be depends on the data, so it is measured: for a sample of queries the
true neighbours are found by brute force, and the share is what most of them need.

Vectors are dealt into blocks of whole cells (a crowded cell is split over several blocks). Every
vector is shuffled once, to its block; a query goes to the blocks that hold its cells. A task holds one
block at a time and streams its queries past it with matrix products, a few rows per query come back.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segmill.operators.staging import stage

#: Values (rows times dimensions) used to fit the centroids, at most.
SAMPLE_VALUES = 1_500_000
#: Vectors per cell aimed at, and the most centroids per half.
PER_CELL, MOST_CENTROIDS = 16, 256
#: Queries whose true neighbours are looked up among all vectors, and the share of those neighbours whose cells a
#: query must reach. Above the recall aimed at (0.9), as it is measured on a sample.
PROBES, REACHED = 128, 0.97
#: Values (rows times dimensions) of a block, and queries that are ranked against it at once.
BLOCK_VALUES, QUERY_ROWS = 1 << 20, 128
_SLACK = 1e-9


def usable(vector: Column) -> Column:
    """Not null, no null or non-finite component, not all zero."""
    number = vector.cast("array<double>")
    finite = F.forall(number, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(number, lambda x: x != 0), F.lit(False))


def kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Centroids of a sample by Lloyd's rounds from evenly spread rows; empty ones keep their place."""
    centroids = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        nearest = _nearest(x, centroids)
        counts = np.bincount(nearest, minlength=k)
        sums = np.stack([np.bincount(nearest, column, k) for column in x.T], axis=1)
        centroids = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centroids)
    return centroids


def _distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return (x**2).sum(axis=1)[:, None] - 2 * x @ centroids.T + (centroids**2).sum(axis=1)


def _nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    parts = [_distances(x[i : i + 4096], centroids).argmin(axis=1) for i in range(0, len(x), 4096)]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def _units(vectors: pd.Series) -> np.ndarray:
    x = np.stack([np.asarray(v, float) for v in vectors])
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def walk(first: np.ndarray, second: np.ndarray, sizes: np.ndarray, wanted: float) -> np.ndarray:
    """Cells (i * K + j) in order of ``first[i] + second[j]`` until they hold ``wanted`` vectors.

    The heap holds one pair per opened row of the table of sums: a row is opened when the
    first pair of the row before it is taken.
    """
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    fa, sb = first[a].tolist(), second[b].tolist()
    heap, out, held, k = [(fa[0] + sb[0], 0, 0)], [], 0, len(b)
    while heap and held < wanted:
        _, i, j = heapq.heappop(heap)
        cell = int(a[i]) * k + int(b[j])
        if sizes[cell]:
            out.append(cell)
            held += int(sizes[cell])
        if j + 1 < k:
            heapq.heappush(heap, (fa[i] + sb[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (fa[i + 1] + sb[0], i + 1, 0))
    return np.array(out, np.int64)


def _blocks(sizes: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray, int]:
    """First block and number of blocks of every cell; blocks hold about ``block`` vectors in whole cells or parts of one."""
    first, parts = np.zeros(len(sizes), np.int64), np.ones(len(sizes), np.int64)
    at, held = 0, 0
    for cell, n in enumerate(sizes):
        if held and held + n > block:
            at, held = at + 1, 0
        first[cell], parts[cell] = at, max(1, -(-int(n) // block))
        if parts[cell] > 1:
            at, held = at + int(parts[cell]), 0
        else:
            held += int(n)
    return first, parts, at + 1


class _Block:
    """The vectors of one block, ready for matrix products."""

    def __init__(self, entries: pd.DataFrame, first_cell: int) -> None:
        self.x = np.stack([np.asarray(v, float) for v in entries["vec"]])
        self.norms = np.sqrt((self.x * self.x).sum(axis=1))
        self.units = self.x / self.norms[:, None]
        self.ids, self.rows = entries["id"].to_numpy(np.int64), entries["row_no"].to_numpy(np.int64)
        self.offsets = entries["cell"].to_numpy(np.int64) - first_cell

    def rank(self, queries: pd.DataFrame, most: int) -> pd.DataFrame:
        """The ``most`` best entries in the visited cells for each query, by exact cosine, then id."""
        q = np.stack([np.asarray(v, float) for v in queries["vec"]])
        q_norms = np.sqrt((q * q).sum(axis=1))
        about = (q / q_norms[:, None]) @ self.units.T
        out = []
        for i, (number, own, bits) in enumerate(zip(queries["id"], queries["row_no"], queries["cells"], strict=True)):
            visited = np.unpackbits(np.frombuffer(bits, np.uint8)).astype(bool)
            inside = np.flatnonzero(visited[self.offsets] & (self.rows != own))
            if len(inside) > most:
                scores = about[i, inside]
                inside = inside[scores >= np.partition(scores, len(scores) - most)[len(scores) - most] - _SLACK]
            exact = (self.x[inside] * q[i]).sum(axis=1) / (self.norms[inside] * q_norms[i])
            order = np.lexsort((self.ids[inside], -exact))[:most]
            out += [(int(own), int(number), int(self.ids[inside[o]]), float(exact[o])) for o in order]
        return pd.DataFrame(out, columns=["query_no", "query_id", "vec_id", "score"])


def _ranked(batches: Iterator[pd.DataFrame], most: int, first_cell: dict[int, int]) -> Iterator[pd.DataFrame]:
    """Ranks the queries of each block. Rows come by block, entries (``cells`` null) before queries."""
    parts, held, now = [], None, None
    for batch in batches:
        for block, rows in batch.groupby("block", sort=True):
            if block != now:
                parts, held, now = [], None, block
            asks = rows["cells"].notna()
            if (~asks).any():
                parts.append(rows[~asks])
            if not asks.any() or not parts and held is None:
                continue
            if held is None:
                held, parts = _Block(pd.concat(parts), first_cell[int(block)]), []
            asking = rows[asks]
            for i in range(0, len(asking), QUERY_ROWS):
                yield held.rank(asking.iloc[i : i + QUERY_ROWS], most)


def _reach(cells: DataFrame, left: np.ndarray, right: np.ndarray, sizes: np.ndarray, most: int) -> float:
    """Share of all vectors that a query must visit so that ``REACHED`` of the true neighbours of a sample of queries are among them."""
    probes = cells.where("asks").orderBy(F.xxhash64("row_no"), "row_no").limit(PROBES).select("row_no", "vec").toPandas()
    if probes.empty:
        return 1.0
    units, own = _units(probes["vec"]), probes["row_no"].to_numpy(np.int64)
    half = left.shape[1]

    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scores, at = np.full((len(units), most), -np.inf), np.zeros((len(units), most), np.int64)
        for b in batches:
            for i in range(0, len(b), 4096):
                part = b.iloc[i : i + 4096]
                cosines = units @ _units(part["vec"]).T
                cosines[own[:, None] == part["row_no"].to_numpy(np.int64)[None, :]] = -np.inf
                scores = np.concatenate([scores, cosines], axis=1)
                at = np.concatenate([at, np.broadcast_to(part["cell"].to_numpy(np.int64), cosines.shape)], axis=1)
                top = np.argpartition(-scores, most - 1, axis=1)[:, :most]
                scores, at = np.take_along_axis(scores, top, axis=1), np.take_along_axis(at, top, axis=1)
        probe, place = np.nonzero(scores > -np.inf)
        yield pd.DataFrame({"probe": probe, "score": scores[probe, place], "cell": at[probe, place]})

    found = cells.select("row_no", "vec", "cell").mapInPandas(best, "probe long, score double, cell long")
    ranked = Window.partitionBy("probe").orderBy(F.desc("score"), "cell")
    true = found.withColumn("place", F.row_number().over(ranked)).where(F.col("place") <= most).select("probe", "cell").toPandas()
    one, two = _distances(units[:, :half], left), _distances(units[:, half:], right)
    needed = []
    for probe, cell in true.groupby("probe")["cell"]:
        sums = (one[probe][:, None] + two[probe][None, :]).ravel()
        order = np.argsort(sums, kind="stable")
        before = np.zeros(len(sums), np.int64)
        before[order] = np.cumsum(sizes[order]) - sizes[order]
        needed += ((before[cell.to_numpy()] + 1) / sizes.sum()).tolist()
    return float(np.quantile(needed, REACHED, method="higher")) if needed else 1.0


def nearest(
    vectors: DataFrame,
    is_query: Column,
    most: int = 5,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    coverage: float | None = None,
    per_cell: int = PER_CELL,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``most`` nearest found of every row that ``is_query`` selects.

    Null, zero and non-finite vectors and null ids take no part. Every other row is a candidate for all
    queries of its length but itself, so rows of one id, repeated ones included, may find each other, and each that is
    a query has ranks of its own. Ties go to the smaller id. ``coverage`` is the share of all vectors that a query visits: with
    1 the result is exact, by default it is measured (see ``_reach``). Empty input gives an empty result; other columns are
    not read, whatever they are called.

    Vectors of each length have an index of their own. The driver gets a sample of at most SAMPLE_VALUES values, PROBES
    queries with their neighbours' cells, and the sizes of the at most MOST_CENTROIDS ** 2 cells.
    """
    v = vectors[f"`{vector}`"]
    rows = vectors.select(vectors[f"`{vec_id}`"].cast("long").alias("vec_id"), v.cast("array<double>").alias("vec"), is_query.alias("asks"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("vec"))).withColumn("row_no", F.monotonically_increasing_id())
    rows = stage(rows.withColumn("asks", F.coalesce("asks", F.lit(False))), "index-rows")
    lengths = rows.groupBy(F.size("vec").alias("d")).agg(F.count("*").alias("n"), F.max("asks").alias("asked")).where("asked").orderBy("d")
    found = [_of_length(rows.where(F.size("vec") == d), d, n, most, coverage, per_cell) for d, n, _ in lengths.collect()]
    if not found:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    best = Window.partitionBy("query_no").orderBy(F.desc("score"), "vec_id")
    return reduce(DataFrame.union, [f.withColumn("rank", F.row_number().over(best)) for f in found]).where(F.col("rank") <= most).select(
        "query_id", "rank", "vec_id", "score"
    )


def _of_length(rows: DataFrame, d: int, n: int, most: int, coverage: float | None, per_cell: int) -> DataFrame:
    """``query_no, query_id, vec_id, score``: the ``most`` best of every block that a query visits, among ``n`` vectors of length ``d``."""
    k = int(min(MOST_CENTROIDS, max(1, np.ceil(np.sqrt(n / per_cell)))))
    sample = max(k, SAMPLE_VALUES // d)
    place = F.pmod(F.xxhash64("vec_id", "vec"), F.lit(1 << 30))
    picked = rows.where(place <= int(min(1.0, 1.05 * sample / n) * (1 << 30))).select("vec_id", "vec").limit(2 * sample).toPandas()
    if picked.empty:  # a few copies of one row may all be above the bound
        picked = rows.select("vec_id", "vec").limit(sample).toPandas()
    units = _units(picked.sort_values("vec_id", kind="stable")["vec"])
    half, k = (d + 1) // 2, min(k, len(units))
    left = kmeans(units[:, :half], k)
    right = kmeans(units[:, half:], k) if d > 1 else np.zeros((k, 0))

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                x = _units(b["vec"])
                yield b.assign(cell=_nearest(x[:, :half], left) * k + _nearest(x[:, half:], right))

    cells = stage(rows.mapInPandas(placed, "vec_id long, vec array<double>, asks boolean, row_no long, cell long"), "index-cells")
    sizes = np.zeros(k * k, np.int64)
    for cell, count in cells.groupBy("cell").count().collect():
        sizes[cell] = count
    wanted = (_reach(cells, left, right, sizes, most) if coverage is None else coverage) * n
    first, parts, n_blocks = _blocks(sizes, max(1, BLOCK_VALUES // d))
    bounds = np.searchsorted(first, np.arange(n_blocks + 1))  # cells of a block are neighbours
    starts = {int(b): int(bounds[b]) for b in range(n_blocks)}
    for cell in np.flatnonzero(parts > 1):
        starts |= {int(first[cell] + p): int(cell) for p in range(int(parts[cell]))}

    def dealt(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            cell, number = b["cell"].to_numpy(), b["row_no"].to_numpy()
            block = first[cell] + (number * 2654435761 >> 16) % parts[cell]
            yield b[["vec_id", "row_no", "vec", "cell"]].rename(columns={"vec_id": "id"}).assign(block=block, cells=None)

    def visits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if not len(b):
                continue
            x = _units(b["vec"])
            one, two = _distances(x[:, :half], left), _distances(x[:, half:], right)
            for i, (number, row_no, vec) in enumerate(zip(b["vec_id"], b["row_no"], b["vec"], strict=True)):
                seen = walk(one[i], two[i], sizes, wanted)
                marks = np.zeros(k * k, np.uint8)
                marks[seen] = 1
                out = []
                for block in np.unique(first[seen]):
                    cell = bounds[block + 1] - 1
                    shares = int(parts[cell])
                    bits = np.packbits(marks[cell : cell + 1] if shares > 1 else marks[bounds[block] : bounds[block + 1]]).tobytes()
                    out += [(number, row_no, vec, -1, int(block) + p, bits) for p in range(shares)]
                yield pd.DataFrame(out, columns=["id", "row_no", "vec", "cell", "block", "cells"])

    schema = "id long, row_no long, vec array<double>, cell long, block long, cells binary"
    queries = cells.where("asks").select("vec_id", "row_no", "vec").mapInPandas(visits, schema)
    entries = cells.select("vec_id", "row_no", "vec", "cell").mapInPandas(dealt, schema)
    by_block = entries.union(queries).repartition("block").sortWithinPartitions("block", F.col("cells").isNotNull())

    def ranked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _ranked(batches, most, starts)

    return by_block.mapInPandas(ranked, "query_no long, query_id long, vec_id long, score double")
