"""Near duplicates by DartMinHash signatures over weighted word shingles.

A shingle that occurs w times owns a region of w unit cells. Every cell is hit by darts
in bands of rising rank; how many, where, and with which rank and coordinate follows from
hashes of shingle, cell and band, so equal regions of two texts get equal darts. Each of the
coordinates keeps its earliest dart, bands are thrown until all have one, and the share of
coordinates on which two texts agree estimates their weighted Jaccard similarity. The
work per text is about k log k darts besides one hash per cell and band.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmill.llm.common import GOLDEN, ROW, Scratch, bounded_batches, mix64, pack, unit, unpack
from segmill.llm.components import components
from segmill.llm.toxicity import word_hashes
from segmill.operators.staging import stage

SHINGLE, SIMILARITY = 5, 0.8
#: 32 bands of 6 coordinates: a pair at similarity 0.8 shares no band once in 16,000 cases,
#: one at 0.85 once in 10**6, while texts at 0.4 meet in 12 of 100.
BANDS, BAND_ROWS = 32, 6
#: Estimates this far from the threshold (over four standard deviations) need no exact check.
MARGIN = 0.12
#: Cells in which frequencies of shingles are counted. However many rare shingles fill them evenly, those
#: that many texts share stand out.
SKETCH = 1 << 17
_FINEST = -12


def shingles(text: str | None, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and counts of the runs of ``width`` words; a shorter text is one shingle, one without words has none."""
    h = word_hashes(text)[0] if text else np.zeros(0, np.uint64)
    if not len(h):
        return h, np.zeros(0, np.int64)
    width = min(width, len(h))
    total = h[: len(h) - width + 1].copy()
    for i in range(1, width):
        total = mix64(total * np.uint64(3) + h[i : len(h) - width + 1 + i])
    return np.unique(total, return_counts=True)


_tables: dict[float, np.ndarray] = {}


def _poisson(width: float) -> np.ndarray:
    """Cumulative probabilities of 0, 1, 2, ... darts in a cell of this area."""
    if width in _tables:
        return _tables[width]
    most = int(width + 12 * np.sqrt(width) + 20)
    steps = np.log(width) - np.log(np.arange(1, most + 1))
    _tables[width] = np.cumsum(np.exp(np.concatenate([[-width], -width + np.cumsum(steps)])))
    return _tables[width]


def signature(elements: np.ndarray, weights: np.ndarray, k: int) -> np.ndarray:
    """The earliest dart of each of ``k`` coordinates; weights may be any positive numbers."""
    out, missing = np.zeros(k, np.uint64), np.ones(k, bool)
    if not len(elements):
        return out
    cells = np.ceil(weights).astype(np.int64)
    owner = np.repeat(np.arange(len(elements)), cells)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(cells) - cells, cells)
    part = np.minimum(1.0, weights[owner] - number)
    cell = mix64(elements[owner] + number.astype(np.uint64) * GOLDEN)
    # With about k log k + 2k darts, nearly always no coordinate is missing; all bands up to there are thrown at once.
    enough = k * (np.log(k) + 2) / max(part.sum(), 1e-9)
    begin, end = 0, max(1, int(np.ceil(np.log2(enough))) - _FINEST + 1)
    while missing.any():
        bands = np.arange(begin, end)
        salts = mix64(bands.astype(np.uint64) + np.uint64(1))
        highs = 2.0 ** (_FINEST + bands)
        lows = np.where(bands > 0, highs / 2, 0.0)
        draws = mix64(cell ^ salts[:, None])
        none = np.minimum(np.exp(lows - highs) * 2.0**64, 2.0**64 - 2048).astype(np.uint64)
        band, at = np.nonzero(draws >= none[:, None])
        thrown = np.ones(len(band), np.int64)
        for i in range(len(bands)):
            mine = slice(*np.searchsorted(band, [i, i + 1]))
            thrown[mine] = np.searchsorted(_poisson(highs[i] - lows[i]), unit(draws[i, at[mine]]), side="right")
        band, at = np.repeat(band, thrown), np.repeat(at, thrown)
        nth = np.arange(len(at)) - np.repeat(np.cumsum(thrown) - thrown, thrown)
        dart = mix64(mix64(cell[at] + salts[band]) + (nth + 1).astype(np.uint64) * GOLDEN)
        rank = lows[band] + unit(mix64(dart + np.uint64(2))) * (highs - lows)[band]
        where = (dart % np.uint64(k)).astype(np.int64)
        use = missing[where] & (unit(mix64(dart + np.uint64(1))) < part[at])
        dart, rank, where = dart[use], rank[use], where[use]
        order = np.argsort(-rank)
        out[where[order]] = dart[order]
        missing[where] = False
        begin, end = end, end + 1
    return out


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact weighted Jaccard similarity of two weighted sets."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(a[1][i], b[1][j]).sum())
    return both / max(int(a[1].sum() + b[1].sum()) - both, 1)


def _signed(texts: Iterator[pd.Series], bands: int, rows: int, width: int) -> Iterator[pd.DataFrame]:
    for batch in texts:
        out = []
        for text in batch:
            elements, counts = shingles(text, width)
            if not len(elements):
                out.append((None, None))
                continue
            short = (signature(elements, counts.astype(float), bands * rows) >> np.uint64(48)).astype(np.uint16)
            hashed = np.arange(1, bands + 1, dtype=np.uint64)
            for column in short.reshape(bands, rows).T:
                hashed = mix64(hashed * np.uint64(5) + column.astype(np.uint64))
            out.append((short.tobytes(), hashed.view(np.int64)))
        yield pd.DataFrame(out, columns=["sig", "bands"])


def _estimate(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(
        [float((np.frombuffer(x, np.uint16) == np.frombuffer(y, np.uint16)).mean()) for x, y in zip(a, b, strict=True)], dtype=float
    )


def _linked(pairs: DataFrame, met: DataFrame, least: float, width: int, scratch: Scratch) -> DataFrame:
    """Those of the distinct ``pairs`` (a, b) whose similarity is ``least`` or more.

    Signatures decide where they leave no doubt; the texts of the other pairs are compared exactly.
    """

    @F.pandas_udf("double")
    def exact(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([similarity(shingles(x, width), shingles(y, width)) for x, y in zip(a, b, strict=True)], dtype=float)

    rated = (
        pairs.join(met.select(F.col("id").alias("a"), F.col("sig").alias("sig_a")), "a")
        .join(met.select(F.col("id").alias("b"), F.col("sig").alias("sig_b")), "b")
        .select("a", "b", F.pandas_udf(_estimate, "double")("sig_a", "sig_b").alias("about"))
        .where(F.col("about") >= least - MARGIN)
    )
    rated = scratch.stage(rated, "near-rated")
    doubtful = rated.where(F.col("about") < least + MARGIN).select("a", "b")
    checked = (
        doubtful.join(met.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
        .join(met.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
        .select("a", "b", exact("text_a", "text_b").alias("exact"))
        .where(F.col("exact") >= least)
    )
    return scratch.stage(rated.where(F.col("about") >= least + MARGIN).select("a", "b").union(checked.select("a", "b")), "near-links")


def _with_centre(members: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) of every member of a band with the band's centre, the one that meets most texts in all bands.

    Edited copies of one text resemble it more than each other, and it is the text that meets most of them.
    """
    centres = members.groupBy("band").agg(F.max(F.struct("met", F.negative("id").alias("back")))["back"].alias("back"))
    met = members.select("id", "band").join(centres.select("band", F.negative("back").alias("centre")), "band").where("id != centre")
    return met.select(F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b")).distinct()


def _split(members: DataFrame, classes: DataFrame, scratch: Scratch) -> DataFrame:
    """The members of bands that hold more than one class, with their class and the band's largest."""
    named = members.join(classes, members["id"] == classes["node"], "left")
    named = scratch.stage(named.select("band", "id", "met", F.coalesce("component", "id").alias("class")), "near-labelled")
    sizes = named.groupBy("band", "class").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("band").agg(F.max(F.struct("n", "class"))["class"].alias("largest"), F.count("*").alias("classes"))
    return scratch.stage(named.join(largest.where("classes > 1").select("band", "largest"), "band"), "near-split")


def _elements(text: str | None, width: int) -> np.ndarray:
    """The weighted set as a plain one: the c-th copy of a shingle is an element of its own."""
    found, counts = shingles(text, width)
    owner = np.repeat(np.arange(len(found)), counts)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    return mix64(found[owner] + number.astype(np.uint64) * GOLDEN)


def _with_common_prefix(split: DataFrame, met: DataFrame, least: float, width: int, scratch: Scratch) -> DataFrame:
    """Distinct pairs (a, b) of unlike classes that can be ``least`` similar, found by the prefixes of their sets.

    With all sets in one order, two sets of similarity t share an element among the first
    n - ceil(t * n) + 1 of each. Rare elements come first: what an edit left behind is rare, so a text
    edited too much to be similar meets no other. Any order gives the same result; frequencies are
    therefore counted in ``SKETCH`` hashed cells, a table of fixed size that tasks can hold. One side is
    always a text that is outside the largest class of one of its bands.
    """
    roles = split.groupBy("id").agg(F.min("class").alias("class"), F.max(F.col("class") != F.col("largest")).alias("minor"))
    held = scratch.stage(met.select("id", "text").join(roles, "id"), "near-held")

    def cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [_elements(t, width) for t in batch["text"]]
            if found:
                cell, n = np.unique((np.concatenate(found) % np.uint64(SKETCH)).astype(np.int64), return_counts=True)
                yield pd.DataFrame({"cell": cell, "n": n})

    counts = held.select("text").mapInPandas(cells, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    often = np.zeros(SKETCH, np.int32)
    often[counts["cell"].to_numpy(np.int64)] = np.minimum(counts["n"].to_numpy(np.int64), 2**31 - 1)

    def prefixes(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text in batch:
                x = _elements(text, width)
                order = np.lexsort((x, often[(x % np.uint64(SKETCH)).astype(np.int64)]))
                out.append((len(x), x[order[: len(x) - int(np.ceil(least * len(x) - 1e-9)) + 1]].view(np.int64)))
            yield pd.DataFrame(out, columns=["n", "prefix"])

    prefixes.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    rows = held.select("id", "class", "minor", F.pandas_udf(prefixes, "n long, prefix array<long>")("text").alias("p"))
    rows = scratch.stage(rows.select("id", "class", "minor", "p.n", F.posexplode("p.prefix").alias("at", "element")), "near-prefixes")
    one = rows.where("minor").select("element", F.col("id").alias("x"), F.col("class").alias("class_x"), F.col("n").alias("n_x"), F.col("at").alias("at_x"))
    # At the first element that two sets share, what is left of both must suffice for the overlap they need.
    enough = F.least(F.col("n") - F.col("at"), F.col("n_x") - F.col("at_x")) >= least / (1 + least) * (F.col("n") + F.col("n_x")) - 1e-6
    near = (F.col("class") != F.col("class_x")) & (F.col("n") >= least * F.col("n_x") - 1e-6) & (F.col("n_x") >= least * F.col("n") - 1e-6) & enough
    found = one.join(rows.drop("minor"), "element").where(near)
    return found.select(F.least("x", "id").alias("a"), F.greatest("x", "id").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame,
    text: str = "text",
    keep: list[str] | None = None,
    least: float = SIMILARITY,
    width: int = SHINGLE,
    bands: int = BANDS,
    rows: int = BAND_ROWS,
) -> DataFrame:
    """The columns ``keep`` (all by default) of every document, with ``row_no`` and ``class_key``.

    Two texts are linked if their weighted sets of ``width``-word shingles are ``least``
    similar or more; classes are the connected components of the links. Equal texts are one
    text, also where they hold no words but marks only; such a text has no other links. A null or empty text is a
    class of its own, with ``class_key`` null. ``row_no`` tells the rows of the result apart, also repeated ones.
    Kept columns of these two names are replaced; an empty table gives an empty one.

    Candidates meet in bands. Every member of a band is compared with the band's centre,
    and the links found give classes. For the texts in bands that still hold two classes, an exact
    join finds all similar pairs of different classes (see ``_with_common_prefix``). So no
    pair that shares a band is lost, and a band of thousands of copies costs about one comparison
    per member.
    """
    bounded_batches(docs.sparkSession)
    keep = docs.columns if keep is None else keep

    @F.pandas_udf("sig binary, bands array<long>")
    def signed_texts(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        yield from _signed(texts, bands, rows, width)

    source = docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keep, text])])
    key = F.unhex(F.md5(F.col(f"`{text}`").cast("binary")))
    packed = pack(source, key=key, found=signed_texts(source[f"`{text}`"]), filled=F.length(source[f"`{text}`"]) > 0, row_no=F.monotonically_increasing_id())
    kept = F.struct(*[F.col(ROW).getField(c).alias(c) for c in keep]).alias(ROW)
    every = stage(packed.select(kept, "row_no", "key", "filled", "found.*"), "near-rows")
    texts = source.select(key.alias("key"), F.col(f"`{text}`").alias("text"))
    signed = every.where("filled").groupBy("key").agg(F.first("sig").alias("sig"), F.first("bands").alias("bands"))
    signed = stage(signed.withColumn("id", F.monotonically_increasing_id()), "near-signed")
    members = signed.select("id", F.explode("bands").alias("band"))
    scratch = Scratch()
    sizes = members.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    shared = scratch.stage(members.join(sizes, "band"), "near-shared")
    shared = scratch.stage(shared.select("id", "band").join(shared.groupBy("id").agg(F.sum("n").alias("met")), "id"), "near-members")
    # Signature and text of those that share a band; the only time that texts are shuffled.
    met = signed.select("key", "id", "sig").join(shared.select("id").distinct(), "id")
    met = texts.join(met, "key").groupBy("id").agg(F.first("sig").alias("sig"), F.first("text").alias("text"))
    met = scratch.stage(met, "near-texts")
    pairs = scratch.stage(_with_centre(shared), "near-pairs")
    links = _linked(pairs, met, least, width, scratch)
    split = _split(shared, components(links, scratch.stage), scratch)
    left = _with_common_prefix(split, met, least, width, scratch).join(pairs, ["a", "b"], "left_anti")
    more = _linked(scratch.stage(left, "near-left"), met, least, width, scratch)
    classes = stage(components(links.union(more), scratch.stage), "near-classes")
    scratch.drop()
    named = signed.select("key", "id").join(classes, F.col("id") == F.col("node"), "left")
    named = every.select(ROW, "row_no", "key").join(named.select("key", F.coalesce("component", "id").alias("class_key")), "key", "left")
    return unpack(named, "row_no", "class_key")


def first_of_each(classed: DataFrame, order: str = "doc_id") -> DataFrame:
    """One row of each class, that with the smallest ``order`` (null last), then ``row_no``; rows without a class stay.

    Takes and returns rows of ``near_duplicates``. Only row numbers are shuffled and joined, which are all different.
    """
    place = F.struct(F.col(order).isNull().alias("none"), F.col(order).alias("order"), F.col("row_no").alias("row_no"))
    firsts = classed.where("class_key is not null").groupBy("class_key").agg(F.min(place)["row_no"].alias("row_no"))
    lone = classed.where("class_key is null").select("row_no")
    return classed.join(firsts.select("row_no").union(lone), "row_no", "left_semi")
