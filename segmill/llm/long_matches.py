"""Removal of long byte strings that occur more than once, exactly, without ordering the corpus.

Every window of LENGTH bytes is keyed by the smallest hash of the K-byte strings in it. Neighbouring
windows mostly share their key, so a text falls into stretches of windows with one key
(split after MOST_WINDOWS), and equal windows always have the same key. Only stretches
are shuffled, as hashes:

1. A stretch whose key occurs nowhere else, nor twice in it, holds nothing that repeats; one that is found again as
   a whole repeats as a whole.
2. For other keys the bytes of each distinct stretch are fetched once. A task takes all stretches of
   some keys, builds a run-length index over them (``run_index``) and streams their
   matching statistics: windows with a match of LENGTH or more elsewhere repeat.
3. Keys with more than CROWD distinct stretches are not brought together: their windows are
   counted one by one by a 128-bit hash, which splits over any number of tasks.

So a passage shared by any number of documents costs a row per document and edge. Texts are
shuffled twice, compressed: those of which bytes are needed, and those that lose a part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmill.llm.common import ROW, bounded_batches, mix64, pack, unpack
from segmill.llm.run_index import matching_statistics
from segmill.operators.staging import stage

LENGTH = 200
K = 32
MOST_WINDOWS = 1024
CROWD = 1024
#: Bytes indexed at once; a block may exceed it by one key's stretches, at most CROWD of them.
BLOCK = 1_500_000
#: Bytes of stretches, and windows, that a task hands on at once: a frame for each text or stretch costs more than its rows do.
_FRAME_BYTES, _FRAME_WINDOWS = 4_000_000, 50_000

# Odd factors that double the length hashed (32 = 2 ** 5), and the hash of a byte.
_FACTORS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)]
_BYTES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_TEXT = ["k1", "k2"]


def stretches(data: bytes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bool]]:
    """Key, first window and end of every stretch of windows, and whether its key comes twice in it.

    None if the data are shorter than ``length``. Only a stretch with its key twice can hold equal windows.
    """
    if len(data) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), []
    h, size = _BYTES[np.frombuffer(data, np.uint8)], 1
    for factor in _FACTORS:
        h = h[:-size] * factor + h[size:]
        size *= 2
    hashed = mix64(h)
    low, size, width = hashed, 1, length - K + 1
    while size * 2 <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if size < width:
        low = np.minimum(low[: len(low) - (width - size)], low[width - size :])
    change = np.concatenate([[0], np.flatnonzero(low[1:] != low[:-1]) + 1, [len(low)]])
    parts = -(-np.diff(change) // MOST_WINDOWS)
    starts = np.repeat(change[:-1], parts) + MOST_WINDOWS * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
    keys, ends = low[starts], np.append(starts[1:], len(low))
    twice = [np.count_nonzero(hashed[a : b - 1 + width] == k) > 1 for k, a, b in zip(keys, starts.tolist(), ends.tolist(), strict=True)]
    return keys.view(np.int64), starts, ends, twice


def _keyed(batches: Iterator[pd.DataFrame], length: int) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for k1, k2, text in zip(batch["k1"], batch["k2"], batch["text"], strict=True):
            data = text.encode("utf-8", "surrogatepass")
            keys, starts, ends, twice = stretches(data, length)
            view = memoryview(data)
            content = [xxhash.xxh3_64_intdigest(view[a : b - 1 + length]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            n = len(keys)
            out.append((np.full(n, k1), np.full(n, k2), starts, ends - starts, keys, np.array(content, np.uint64).view(np.int64), np.array(twice, bool)))
        if out:
            columns = [np.concatenate(c) for c in zip(*out, strict=True)]
            yield pd.DataFrame(dict(zip(["k1", "k2", "first", "windows", "key", "content", "twice"], columns, strict=True))).astype(
                {"first": "int32", "windows": "int32"}
            )


def _cut(batches: Iterator[pd.DataFrame], length: int) -> Iterator[pd.DataFrame]:
    """The bytes of the stretches wanted of each text, those of many texts in a frame."""
    open_, held, size = zstandard.ZstdDecompressor().decompress, [], 0

    def rows() -> pd.DataFrame:
        return pd.DataFrame(held, columns=["key", "content", "crowded", "alone", "data"])

    for batch in batches:
        for packed, wanted in zip(batch["packed"], batch["wanted"], strict=True):
            data = open_(packed)
            for w in wanted:
                held.append((w["key"], w["content"], w["crowded"], w["alone"], data[w["first"] : w["first"] + w["windows"] - 1 + length]))
                size += len(held[-1][-1])
            if size >= _FRAME_BYTES:
                yield rows()
                held, size = [], 0
    if held:
        yield rows()


def _indexed(batches: Iterator[pd.DataFrame], length: int, block: int) -> Iterator[pd.DataFrame]:
    """Repeating windows of stretches that occur once; rows come in order of key."""

    def marks(rows: list[tuple]) -> pd.DataFrame:
        longest, firsts = matching_statistics([r[3] for r in rows])
        # The last positions of a string have no match of this length, so no run goes on into the next.
        change = np.diff(np.concatenate([[0], longest >= length, [0]]).astype(np.int8))
        low, high = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
        of = np.searchsorted(firsts, low, "right") - 1
        hit = np.array([r[2] for r in rows], bool)[of]
        low, high, of = low[hit], high[hit], of[hit]
        key, content = (np.array([r[i] for r in rows], np.int64)[of] for i in (0, 1))
        return pd.DataFrame({"key": key, "content": content, "low": low - firsts[of], "high": high - firsts[of]})

    held: list[tuple] = []
    size, last = 0, None
    for batch in batches:
        for key, content, alone, data in zip(batch["key"], batch["content"], batch["alone"], batch["data"], strict=True):
            if key != last and size >= block:
                yield marks(held)
                held, size = [], 0
            held.append((key, content, alone, data))
            size, last = size + len(data), key
    if held:
        yield marks(held)


def _windowed(batches: Iterator[pd.DataFrame], length: int) -> Iterator[pd.DataFrame]:
    """A 128-bit hash of every window, those of many stretches in a frame."""
    held: list[tuple] = []
    digests: list[bytes] = []

    def rows() -> pd.DataFrame:
        key, content, alone, n = (np.array(c) for c in zip(*held, strict=True))
        hashes = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
        low = np.arange(len(hashes)) - np.repeat(np.cumsum(n) - n, n)
        return pd.DataFrame(
            {"w1": hashes[:, 0], "w2": hashes[:, 1], "key": np.repeat(key, n), "content": np.repeat(content, n), "alone": np.repeat(alone, n), "low": low}
        )

    for batch in batches:
        for key, content, alone, data in zip(batch["key"], batch["content"], batch["alone"], batch["data"], strict=True):
            view, n = memoryview(data), len(data) - length + 1
            digests += [xxhash.xxh3_128_digest(view[i : i + length]) for i in range(n)]
            held.append((key, content, alone, n))
            if len(digests) >= _FRAME_WINDOWS:
                yield rows()
                held.clear()
                digests.clear()
    if held:
        yield rows()


def covered(spans: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """Bytes under the windows [low, high), as sorted runs apart from each other."""
    out: list[list[int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1]:
            out[-1][1] = max(out[-1][1], high - 1 + length)
        else:
            out.append([low, high - 1 + length])
    return [(a, b) for a, b in out]


def _packed(text: Column) -> Column:
    def squeezed(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for batch in texts:
            yield pd.Series([squeeze(t.encode("utf-8", "surrogatepass")) for t in batch], dtype=object)

    squeezed.__annotations__ = {"texts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(squeezed, "binary")(text)


def repeated_windows(texts: DataFrame, length: int = LENGTH, crowd: int = CROWD, block: int = BLOCK) -> DataFrame:
    """``k1, k2, low, high``: windows [low, high) of a text that also start elsewhere in the table.

    ``texts`` has a row per document: ``k1, k2`` (a 128-bit hash of the text) and ``text``.
    """
    keyed = texts.select(*_TEXT, "text").mapInPandas(
        lambda b: _keyed(b, length), "k1 long, k2 long, first int, windows int, key long, content long, twice boolean"
    )
    keyed = stage(keyed, "match-stretches")
    counted = keyed.groupBy("key").agg(F.count("*").alias("n"), F.max("twice").alias("twice"), F.min("content").alias("a"), F.max("content").alias("b"))
    shared = counted.where("n > 1 or twice").select("key", ((F.col("a") != F.col("b")) | (F.col("n") == 1)).alias("mixed"))
    hits = stage(keyed.drop("twice").join(shared, "key"), "match-hits")
    whole = hits.where("not mixed").select(*_TEXT, "first", "windows")
    mixed = hits.where("mixed")
    contents = mixed.groupBy("key", "content").agg(F.count("*").alias("n"), F.min(F.struct(*_TEXT, "first", "windows")).alias("at"))
    contents = stage(contents, "match-contents")
    again = mixed.join(contents.where("n > 1").select("key", "content"), ["key", "content"]).select(*_TEXT, "first", "windows")
    crowds = contents.groupBy("key").agg(F.count("*").alias("contents"), F.max(F.col("n") == 1).alias("open")).where("open")
    wanted = contents.join(crowds.select("key", (F.col("contents") > crowd).alias("crowded")), "key").select(
        "at.k1", "at.k2", F.struct("key", "content", "crowded", (F.col("n") == 1).alias("alone"), "at.first", "at.windows").alias("w")
    )
    wanted = stage(wanted.groupBy(*_TEXT).agg(F.collect_list("w").alias("wanted")), "match-wanted")
    needed = texts.select(*_TEXT, _packed(F.col("text")).alias("packed")).groupBy(*_TEXT).agg(F.first("packed").alias("packed"))
    pieces = needed.join(wanted, _TEXT).mapInPandas(
        lambda b: _cut(b, length), "key long, content long, crowded boolean, alone boolean, data binary"
    )
    pieces = stage(pieces, "match-pieces")
    found = "key long, content long, low long, high long"
    indexed = (
        pieces.where("not crowded")
        .select("key", "content", "alone", "data")
        .repartition("key")
        .sortWithinPartitions("key")
        .mapInPandas(lambda b: _indexed(b, length, block), found)
    )
    windows = pieces.where("crowded").mapInPandas(
        lambda b: _windowed(b, length), "w1 long, w2 long, key long, content long, alone boolean, low long"
    )
    windows = stage(windows, "match-windows")
    twice = windows.groupBy("w1", "w2").agg((F.count("*") + F.sum(F.when(~F.col("alone"), 1).otherwise(0))).alias("n")).where("n > 1")
    counted = windows.where("alone").join(twice, ["w1", "w2"]).select("key", "content", "low", (F.col("low") + 1).alias("high"))
    marks = indexed.union(counted)
    parts = marks.join(contents.where("n = 1").select("key", "content", "at"), ["key", "content"]).select(
        "at.k1", "at.k2", (F.col("low") + F.col("at.first")).alias("low"), (F.col("high") + F.col("at.first")).alias("high")
    )
    all_of = whole.union(again).select(*_TEXT, F.col("first").cast("long").alias("low"), (F.col("first") + F.col("windows")).cast("long").alias("high"))
    return parts.union(all_of)


def remove_repeats(docs: DataFrame, text: str = "text", keep: list[str] | None = None, length: int = LENGTH) -> DataFrame:
    """What is left of every document without the bytes that a repeated string of ``length`` bytes covers.

    The columns ``keep`` (all by default) with ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed
    runs), ``kept_sha256`` and ``spans`` (array of start, end: bytes of the UTF-8 text, end
    exclusive; null for texts removed whole and of which nothing is removed). A
    string repeats if it starts at any other place of the table, in the same document
    too; overlapping places count, and places are judged on the input. Null texts count as empty. Texts shorter than
    ``length`` lose nothing; rows with equal texts of ``length`` or more lose all.
    Result columns replace kept ones of the same name. An empty table gives an empty one.
    """
    bounded_batches(docs.sparkSession)
    keep = docs.columns if keep is None else keep
    source = docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keep, text])])
    whole = F.coalesce(source[f"`{text}`"].cast("string"), F.lit(""))
    packed = pack(source, text=whole, k1=F.xxhash64(whole), k2=F.xxhash64(F.lit(1), whole))
    kept = F.struct(*[F.col(ROW).getField(c).alias(c) for c in keep]).alias(ROW)
    rows = packed.select(
        kept, *_TEXT, F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("full_sha256")
    )
    rows = stage(rows, "match-rows")
    texts = packed.select(*_TEXT, "text")
    spans = stage(
        repeated_windows(texts, length).groupBy(*_TEXT).agg(F.collect_set(F.struct("low", "high")).alias("windows")), "match-spans"
    )

    def merged(windows: pd.Series) -> pd.Series:
        return pd.Series([covered([(w["low"], w["high"]) for w in row], length) for row in windows], dtype=object)

    runs = spans.select(*_TEXT, F.pandas_udf(merged, "array<struct<start:long,end:long>>")("windows").alias("spans"))
    runs = runs.withColumn("n_removed", F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"]))
    sizes = rows.groupBy(*_TEXT).agg(F.first("n_bytes").alias("n_bytes"))
    runs = stage(runs.join(sizes, _TEXT), "match-runs")
    partial = runs.where("n_removed < n_bytes").select(*_TEXT, "spans")

    def rest(packed_texts: pd.Series, cuts: pd.Series) -> pd.Series:
        open_, out = zstandard.ZstdDecompressor().decompress, []
        for packed_text, spans_ in zip(packed_texts, cuts, strict=True):
            data, digest, at = memoryview(open_(packed_text)), hashlib.sha256(), 0
            for s in spans_:
                digest.update(data[at : s["start"]])
                at = s["end"]
            digest.update(data[at:])
            out.append(digest.hexdigest())
        return pd.Series(out, dtype=object)

    needed = texts.select(*_TEXT, _packed(F.col("text")).alias("packed")).groupBy(*_TEXT).agg(F.first("packed").alias("packed"))
    hashed = needed.join(partial, _TEXT).select(*_TEXT, F.pandas_udf(rest, "string")("packed", "spans").alias("rest_sha256"))
    known = stage(
        runs.select(*_TEXT, "n_removed", F.size("spans").cast("long").alias("n_spans"), F.when(F.col("n_removed") < F.col("n_bytes"), F.col("spans")).alias("spans"))
        .join(hashed, _TEXT, "left"),
        "match-known",
    )
    result = (
        rows.join(known, _TEXT, "left")
        .withColumn(
            "kept_sha256",
            F.when(F.col("n_removed").isNull(), F.col("full_sha256")).otherwise(F.coalesce("rest_sha256", F.sha2(F.lit("").cast("binary"), 256))),
        )
        .withColumn("n_removed", F.coalesce("n_removed", F.lit(0).cast("long")))
        .withColumn("n_spans", F.coalesce("n_spans", F.lit(0).cast("long")))
    )
    return unpack(result, "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans")
