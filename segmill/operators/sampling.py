"""Capping a table at a number of rows.

Two ways to do it. ``bernoulli`` keeps each row with probability target / rows and
then cuts off what is above the target, so it may keep a few rows too few; which rows that are depends on how the
table is partitioned, or, with keys, on nothing but the keys and the seed. ``hash`` keeps exactly
the rows with the smallest hashes, which depends on nothing but the rows and the
seed. A hash does not care how often a row occurs, so such a sample can be drawn
below a duplicate removal: only rows that can be in the sample get shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmill.functions.columns import named
from segmill.operators.staging import drop_staged, stage

_RANK = "__rank"
_DIGITS = 2  # hex digits per refinement: 256 counts reach the driver
_EDGE_ROWS = 100_000  # rows that may be sorted and cut in one place
_SLICES = 64
_SIGN = -(2**63)


def _hashable(value: Column, dtype: T.DataType) -> Column:
    """``value`` in a form that Spark hashes: maps as entries in order of key, variants as text."""
    if isinstance(dtype, T.StructType):
        parts = [_hashable(value.getField(f.name), f.dataType).alias(f.name) for f in dtype.fields]
        return F.when(value.isNotNull(), F.struct(*parts)) if parts else value
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda x: _hashable(x, dtype.elementType))
    if isinstance(dtype, T.MapType):
        pair = T.StructType([T.StructField("key", dtype.keyType), T.StructField("value", dtype.valueType)])
        keys = F.array_sort(F.map_keys(value))
        pairs = F.transform(keys, lambda k: F.struct(k.alias("key"), F.element_at(value, k).alias("value")))
        return _hashable(pairs, T.ArrayType(pair))
    return value.cast("string") if isinstance(dtype, T.VariantType) else value


def _row_hash(df: DataFrame, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), *[_hashable(named(f.name), f.dataType) for f in df.schema.fields])


def _hex(hash64: Column) -> Column:
    """16 hex digits that sort as the signed 64-bit hash does."""
    return F.lpad(F.hex(hash64.bitwiseXOR(F.lit(_SIGN))), 16, "0")


def row_rank(df: DataFrame, seed: int = 42, keys: Sequence[str] | None = None) -> Column:
    """A hex string per row that puts the rows of ``df`` in a random but repeatable order.

    With ``keys`` it starts with the MD5 of their text followed by ``#seed``, which
    any SQL engine can recompute; the hash of the whole row then orders equal keys.
    """
    if keys is None:
        return F.concat(_hex(_row_hash(df, seed)), _hex(_row_hash(df, seed + 1)))
    key_text = F.concat_ws("#", *[named(k).cast("string") for k in keys], F.lit(str(seed)))
    return F.concat(F.md5(key_text), _hex(_row_hash(df, seed)))


def smallest(df: DataFrame, rank: Column, n: int) -> DataFrame:
    """The ``n`` rows with the smallest rank, or ``df`` itself if it has no more.

    The cut is found from row counts per leading digits of the rank, two digits at a
    time. Rows clearly below it are then a plain filter, without shuffle or limit;
    only the few rows that share the digits at the cut are sorted, ``_EDGE_ROWS`` at most.
    Rows of the same rank are told apart by a hash of their place in the table, so a
    cut through any number of equal rows is found in the same way.
    """
    place = F.lpad(F.hex(F.xxhash64(F.monotonically_increasing_id())), 16, "0")
    ranked = df.withColumn(_RANK, F.concat(rank, place))
    prefix, need = "", n
    while True:
        width = len(prefix) + _DIGITS
        scope = ranked.where(F.col(_RANK).startswith(prefix)) if prefix else ranked
        counts = dict(scope.groupBy(F.substring(_RANK, 1, width)).count().collect())
        if not prefix and sum(counts.values()) <= n:
            return df
        for digits in sorted(counts):
            if counts[digits] >= need:
                break
            need -= counts[digits]
        exhausted = digits == prefix  # two places with one hash, once in 10 ** 19 pairs
        prefix = digits
        if counts[prefix] == need:
            return ranked.where(F.substring(_RANK, 1, len(prefix)) <= prefix).drop(_RANK)
        if counts[prefix] <= _EDGE_ROWS or exhausted:
            break
    below = ranked.where(F.substring(_RANK, 1, len(prefix)) < prefix)
    edge = ranked.where(F.col(_RANK).startswith(prefix)).orderBy(_RANK).limit(need)
    return below.unionByName(edge).drop(_RANK)


def _drawn(df: DataFrame, n: int, rows: int, seed: int, keys: Sequence[str] | None) -> DataFrame:
    """Each of the ``rows`` rows with probability ``n / rows``, but at most ``n`` of them.

    One pass: it writes the rows drawn, and counts them by 64 slices of their random number on the way. What
    is too much then lies in one slice, and only that is sorted.
    """
    if keys is None:
        number = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.monotonically_increasing_id()), 4)
    else:
        number = F.conv(F.substring(row_rank(df, seed, keys), 1, 15), 16, 10).cast("long")
    bound = int(n / rows * 16**15)
    width = -(-bound // _SLICES)
    ranked = df.withColumn(_RANK, F.struct(number.alias("number"), _row_hash(df, seed).alias("row"))).where(F.col(_RANK)["number"] < bound)
    slice_ = F.floor(F.col(_RANK)["number"] / width)
    seen = Observation()
    counted = [F.count(F.when(slice_ == i, 1)).alias(f"slice_{i}") for i in range(_SLICES)]
    staged = stage(ranked.observe(seen, *counted), "drawn")
    counts = [seen.get[f"slice_{i}"] for i in range(_SLICES)]
    if sum(counts) <= n:
        return staged.drop(_RANK)
    need = n
    for cut, count in enumerate(counts):
        if count >= need:
            break
        need -= count
    below, edge = staged.where(slice_ < cut), staged.where(slice_ == cut)
    if counts[cut] > _EDGE_ROWS:
        edge = smallest(edge.withColumnRenamed(_RANK, "__drawn"), F.lpad(F.hex(F.col("__drawn")["number"]), 16, "0"), need).withColumnRenamed("__drawn", _RANK)
    else:
        edge = edge.orderBy(_RANK).limit(need)
    return below.unionByName(edge).drop(_RANK)


def cap_rows(
    df: DataFrame,
    n: int,
    seed: int = 42,
    mode: str = "bernoulli",
    keys: Sequence[str] | None = None,
) -> DataFrame:
    """At most ``n`` rows of ``df``; a table that has no more is returned unchanged.

    ``df`` is read more than once, so it should be a table or ``stage``d, not the outcome of a long plan: ``bernoulli``
    counts it and draws in one pass. ``keys`` names the columns whose hash is the rank; without them it is a hash of
    the whole row (``hash``), or rows are drawn by their place in the table (``bernoulli``). Rows of equal keys are drawn
    together, and told apart by a hash of the row where the cut is among them.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    if mode == "hash":
        return smallest(df, row_rank(df, seed, keys), n)
    if mode != "bernoulli":
        raise ValueError(f"mode must be 'bernoulli' or 'hash', not {mode!r}")
    rows = df.count()
    return df if rows <= n else _drawn(df, n, rows, seed, keys)


def distinct_sample(
    df: DataFrame, n: int, seed: int, rows: int, keys: Sequence[str] | None = None
) -> tuple[DataFrame, int]:
    """``smallest`` of the distinct rows of ``df``, which has ``rows`` rows, and how many that are.

    The result is that of removing duplicates first. But since copies of a row share
    its hash, all rows with a hash above a rough bound are filtered out before the
    duplicate removal, whose shuffle then moves about 2n rows instead of the table.
    The bound follows from an estimate of the number of distinct ranks; if it falls
    short all the same, it is lifted. With ``keys`` the rank is that of ``row_rank``;
    rows of few distinct keys then all pass the bound, which costs their shuffle only.
    """
    rank = row_rank(df, seed, keys)
    head = F.substring(rank, 1, 15)
    slack = 6 * n**0.5 + 10  # far beyond what chance takes away from n hits
    wanted = 1.0
    if n < rows:
        distinct = df.agg(F.approx_count_distinct(head, 0.01)).first()[0]
        wanted = min(1.0, (1.1 * n + slack) / max(distinct, 1))
    for share in dict.fromkeys((wanted, 1.0)):
        below = df if share == 1.0 else df.where(head < F.lit(f"{int(share * 16**15):015X}" if keys is None else f"{int(share * 16**15):015x}"))
        candidates = stage(below.dropDuplicates(), "candidates")
        found = candidates.count()  # from the file footers
        if found > n:
            return smallest(candidates, row_rank(candidates, seed, keys), n), n
        if found == n or share == 1.0:
            return candidates, found
        drop_staged(candidates)
    raise AssertionError("unreachable: the last bound admits every row")
