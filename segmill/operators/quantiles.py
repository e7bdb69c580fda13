"""Exact quantiles of many columns at once, without sorting a column or holding it in one place.

The search narrows a range of values per column that holds the wanted rank. Every pass counts the rows
of a few ranges exactly and takes a mergeable KLL sketch of each, whose quantiles cut the range with the
rank down to about a hundredth of its rows for the next pass. It ends when a range holds a single
value, or so few rows that one exact aggregate over them settles the rest. Edges are set by rank, so the shape of a
distribution does not matter: n rows take 2 + r passes for the smallest r with n <= SETTLE_ROWS * 100 ** r.
Counting and sketching are done inside the tasks, and sketches meet in groups before they meet in one place; columns
are searched in groups of ``COLUMNS``, each reading its own columns only.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from segmill.functions.columns import as_double, named

COLUMNS = 24
_SETTLE_ROWS = 10_000
#: Size of a sketch, and the share of ranks by which its quantiles are off at most, in 99 of 100 cases, with some room.
_SKETCH = 2048
_OFF = 0.0035
#: Groups of tasks whose sketches are merged before those of all.
_GROUPS = 64


@dataclass
class _Range:
    """Values of a column from ``low`` to ``high``, both of which occur; ``rank`` counts from 1 within it."""

    column: str
    rank: int
    low: float
    high: float
    rows: int
    sketch: bytearray | None = None

    @property
    def x(self) -> Column:
        return F.col(self.column)

    @property
    def inside(self) -> Column:
        return self.x.between(self.low, self.high)

    def part(self, parts: Sequence[Row]) -> _Range:
        """The one of the ``parts`` (in order of value) that holds the rank."""
        rank = self.rank
        for p in parts:
            if rank <= p.n:
                return _Range(self.column, rank, p.low, p.high, p.n, p.sketch)
            rank -= p.n
        raise AssertionError("the parts hold fewer rows than the range")


def _whole(values: DataFrame, p: float) -> list[_Range]:
    """One pass: rows, ends and sketch of each column."""
    measures = {"n": F.count, "lo": F.min, "hi": F.max, "sketch": lambda c: F.kll_sketch_agg_double(c, _SKETCH)}
    merged = {"n": F.sum, "lo": F.min, "hi": F.max, "sketch": lambda c: F.kll_merge_agg_double(c, _SKETCH)}
    group = F.pmod(F.spark_partition_id(), F.lit(_GROUPS)).alias("group")
    names = [(f"{m}_{c}", m, c) for c in values.columns for m in measures]
    parts = values.groupBy(group).agg(*[measures[m](c).alias(name) for name, m, c in names])
    got = parts.agg(*[merged[m](name).alias(name) for name, m, c in names]).first()
    return [
        _Range(c, max(1, math.ceil(p * got[f"n_{c}"])), got[f"lo_{c}"], got[f"hi_{c}"], got[f"n_{c}"], got[f"sketch_{c}"])
        for c in values.columns
        if got[f"n_{c}"]
    ]


def _edges(values: DataFrame, ranges: list[_Range]) -> list[tuple[float, float, float]]:
    """Three values of each range, around the wanted rank, by its sketch."""
    shares = [[min(max((r.rank - 0.5) / r.rows + side * _OFF, 0.0), 1.0) for side in (-1, 0, 1)] for r in ranges]
    found = [F.kll_sketch_get_quantile_double(F.lit(bytes(r.sketch)), F.array(*map(F.lit, s))) for r, s in zip(ranges, shares)]
    return [tuple(edges) for edges in values.sparkSession.range(1).select(*found).first()]


def _narrow(values: DataFrame, ranges: list[_Range]) -> list[_Range]:
    """One pass: exact counts and sketches of the values between a sketch's quantiles around the wanted rank.

    The middle one of the three quantiles occurs in the range and is counted alone, so every
    call leaves fewer values.
    """
    cells = []
    for i, (r, (low, mid, high)) in enumerate(zip(ranges, _edges(values, ranges))):
        part = F.when(r.x < low, 0).when(r.x < mid, 1).when(r.x == mid, 2).when(r.x <= high, 3).otherwise(4)
        cells.append(F.struct(F.lit(i).alias("i"), F.when(r.inside, part).alias("part"), r.x.alias("x")))
    counted = (
        values.where(reduce(Column.__or__, [r.inside for r in ranges]))
        .select(F.inline(F.array(*cells)))
        .where(F.col("part").isNotNull())
        .groupBy("i", "part")
        .agg(F.count("*").alias("n"), F.min("x").alias("low"), F.max("x").alias("high"), F.kll_sketch_agg_double("x", _SKETCH).alias("sketch"))
        .collect()  # at most five rows per column
    )
    counted.sort(key=lambda c: c.part)
    return [r.part([c for c in counted if c.i == i]) for i, r in enumerate(ranges)]


def _settle(values: DataFrame, ranges: list[_Range]) -> dict[str, float]:
    # With an accuracy beyond the number of rows the aggregate is exact.
    measures = [
        F.percentile_approx(
            F.when(r.inside, r.x), F.lit((r.rank - 0.5) / r.rows), F.lit(4 * max(_SETTLE_ROWS, 1000))
        ).alias(r.column)
        for r in ranges
    ]
    return values.agg(*measures).first().asDict()


def exact_quantiles(df: DataFrame, columns: Sequence[str], p: float = 0.5) -> dict[str, float | None]:
    """The smallest value at or below which a share ``p`` of the values lies, per column.

    Null and NaN do not count as values; a column without values gives None. ``df``
    is read a few times, so it should be a table or staged.
    """
    found: dict[str, float | None] = {}
    for start in range(0, len(columns), COLUMNS):
        found |= search(df, columns[start : start + COLUMNS], p)[0]
    return found


def search(df: DataFrame, columns: Sequence[str], p: float) -> tuple[dict[str, float | None], int]:
    """``exact_quantiles`` of one group of columns, and the number of passes over ``df`` it took."""
    short = {f"c{i}": c for i, c in enumerate(columns)}
    values = df.select(*[F.nanvl(as_double(named(c)), F.lit(None)).alias(s) for s, c in short.items()])

    found: dict[str, float | None] = dict.fromkeys(short)
    few: list[_Range] = []

    def still_open(ranges: list[_Range]) -> list[_Range]:
        found.update({r.column: r.low for r in ranges if r.low == r.high})
        several = [r for r in ranges if r.low != r.high]
        few.extend(r for r in several if r.rows <= _SETTLE_ROWS)
        return [r for r in several if r.rows > _SETTLE_ROWS]

    ranges, passes = still_open(_whole(values, p)), 1
    while ranges:
        ranges, passes = still_open(_narrow(values, ranges)), passes + 1
    if few:
        found.update(_settle(values, few))
        passes += 1
    return {c: found[s] for s, c in short.items()}, passes
