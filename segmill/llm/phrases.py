"""Collocations: phrases of several words that occur together far more often than their parts would.

Words are counted first, and those that are frequent get numbers. From then on the corpus is arrays of numbers,
in which 0 stands for an infrequent word or the end of a piece. Phrases of k words are counted level by level:

* A phrase can be frequent only if its first and its last k - 1 words are. Tries of the frequent phrases of one
  level tell for all positions at once where that holds.
* Such windows are summed in hash buckets first. A bucket holds at least what each of its
  phrases does, so only phrases of buckets that reach the threshold are candidates; none is lost.
* Candidates go into double-array tries, which are broadcast. All positions of a block advance together, the rows of the
  states that accept are counted by ``bincount``, and the counts of all tasks are summed.

Everything broadcast or collected has a bound: vocabularies, buckets and tries beyond it are split by hash, and
the corpus is read once for each part. Of the corpus's phrases none goes through the driver but those bounded parts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from segmill.llm.common import GOLDEN, Scratch, mix64
from segmill.llm.tries import Trie, build
from segmill.operators.staging import stage

# A-Z become a-z, marks that end a piece become a line feed, a tab becomes a blank.
_BYTES = bytes.maketrans(bytes(range(65, 91)) + b".,;:!?\n\x0b\x0c\r\t", bytes(range(97, 123)) + b"\n" * 10 + b" ")
#: Between pieces; no UTF-8 text holds this byte.
_END = b"\xff"

#: Bounds of what a task is given: words of a vocabulary and their bytes, phrases of a trie, phrases with their texts, hash buckets.
VOCABULARY, _VOCABULARY_BYTES = 500_000, 64_000_000
TRIE = 1_000_000
_TEXTS, _TEXT_BYTES = 200_000, 64_000_000
BUCKETS = 1 << 28  # a bit each: 32 MB
#: Windows that a task gathers before it drops those that it has already.
_HELD = 1 << 20
#: Languages up to which their totals are broadcast.
BROADCAST_LANGS = 10_000
_SALTS = 64
#: Tasks per core that count, and candidates whose counts are added up together.
_TASKS, _PIECE = 3, 8192
#: Words of a block.
_BLOCK = 1 << 20


def words_of(text: bytes) -> list[bytes]:
    """The words of a text in lower case, with ``_END`` at the end of every piece but the last."""
    return text.translate(_BYTES).replace(b"\n", b" \xff ").split()


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    for batch in batches:
        yield from zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist())


def _word_counts(docs: DataFrame) -> DataFrame:
    """``lang, word, n``; the row of a language with a null word has the number of all its words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[str, Counter] = {}
            for lang, text in _texts(iter([batch])):
                found.setdefault(lang, Counter()).update(words_of(text))
            for lang, counts in found.items():
                counts.pop(_END, 0)
                words = pa.array([None, *counts], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(words)), words, pa.array([counts.total(), *counts.values()])], names=["lang", "word", "n"])

    return docs.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _numbered(words: DataFrame, scratch: Scratch) -> DataFrame:
    """``words`` with numbers from 1 in descending order of ``n``, without gaps: small numbers for frequent words."""
    ordered = words.orderBy(F.col("n").desc(), "lang", "word").withColumn("place", F.monotonically_increasing_id())
    placed = scratch.stage(ordered, "vocabulary")
    part = F.shiftright("place", 33)
    counts = sorted((r.part, r.n) for r in placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())  # one per task
    before, start = {}, 1
    for number, count in counts:
        before[number], start = start, start + count
    if not before:
        return placed.withColumn("id", F.lit(0)).drop("place")
    offset = F.element_at(F.create_map(*[F.lit(x) for pair in before.items() for x in pair]), part)
    return placed.withColumn("id", (F.col("place").bitwiseAND((1 << 33) - 1) + offset).cast("int")).drop("place")


def _runs(numbers: list[np.ndarray]) -> np.ndarray:
    """The arrays one after the other with a 0 after each; zeros in a row become one, and lone words go: they are in no phrase."""
    ids = np.concatenate([x for n in numbers for x in (n, np.zeros(1, np.int32))]) if numbers else np.zeros(0, np.int32)
    beside = np.zeros(len(ids), bool)
    pairs = (ids[1:] > 0) & (ids[:-1] > 0)
    beside[1:] |= pairs
    beside[:-1] |= pairs
    ids = np.where(beside, ids, 0)
    return ids[(ids > 0) | (np.append(ids[1:], 0) > 0)]


def _blocks(arrays: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([_runs(held).astype("<i4").tobytes()])], names=["ids"])

    held, size = [], 0
    for array in arrays:
        held.append(array)
        size += len(array)
        if size >= _BLOCK:
            yield row()
            held, size = [], 0
    if held:
        yield row()


def _encoded(docs: DataFrame, words: DataFrame) -> DataFrame:
    """The corpus as blocks of word numbers, from a broadcast vocabulary or, beyond its bound, from a join by word."""
    spark = docs.sparkSession
    size = words.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("word")), F.lit(0))).first()
    if size[0] <= VOCABULARY and size[1] <= _VOCABULARY_BYTES:
        vocabulary: dict[str, dict[bytes, int]] = {}
        for row in words.toArrow().to_pylist():
            vocabulary.setdefault(row["lang"], {})[row["word"].encode()] = row["id"]
        shared = spark.sparkContext.broadcast(vocabulary)

        def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = shared.value

            def arrays() -> Iterator[np.ndarray]:
                for lang, text in _texts(batches):
                    number, found = known.get(lang, {}).get, words_of(text)
                    yield np.array([number(w, 0) for w in found], np.int32)

            yield from _blocks(arrays())

        return docs.mapInArrow(encode, "ids binary")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text, doc in zip(*(batch.column(i).to_pylist() for i in range(3))):
                found = [w.decode() if w != _END else None for w in words_of(text.encode())]
                rows = [pa.array([v] * len(found), t) for v, t in ((doc, pa.int64()), (lang, pa.string()))]
                yield pa.RecordBatch.from_arrays([*rows, pa.array(range(len(found)), pa.int64()), pa.array(found, pa.string())], names=["doc", "lang", "at", "word"])

    # A frequent word is spread over the salts; a text of any length has its numbers in one row again.
    salted = words.select("lang", "word", "id", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("salt"))
    placed = docs.withColumn("doc", F.monotonically_increasing_id()).mapInArrow(split, "doc long, lang string, at long, word string")
    placed = placed.withColumn("salt", F.pmod(F.xxhash64("doc", "at"), F.lit(_SALTS)).cast("int"))
    found = placed.join(salted, ["lang", "word", "salt"]).groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("at", "id"))).alias("found"))
    ids = found.select(F.col("found.at").alias("at"), F.col("found.id").alias("id"))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def arrays() -> Iterator[np.ndarray]:
            for batch in batches:
                for i in range(batch.num_rows):
                    at, id_ = (batch.column(c)[i].values.to_numpy() for c in (0, 1))
                    gap = np.diff(at, prepend=at[:1]) > 1  # an infrequent word or an end between the two
                    yield np.insert(id_.astype(np.int32), np.flatnonzero(gap), 0)

        yield from _blocks(arrays())

    return ids.mapInArrow(gather, "ids binary")


def _keys(table: DataFrame, length: int) -> np.ndarray:
    """The phrases of a bounded table as rows of word numbers."""
    column = table.select("key").toArrow().column("key").to_pylist()
    return np.frombuffer(b"".join(column), "<i4").reshape(-1, length).astype(np.int64)


def _parts(table: DataFrame, bound: int) -> list[DataFrame]:
    """``table`` (with ``key``) in parts of at most about ``bound`` rows, by hash of the phrase."""
    parts = -(-table.count() // bound)
    part = F.pmod(F.xxhash64(F.col("key"), F.lit(7)), F.lit(max(parts, 1)))
    return [table.where(part == i) if parts > 1 else table for i in range(parts)]


def _trie_arrays(keys: np.ndarray) -> tuple[Any, ...]:
    trie = build(keys)
    return trie.base, trie.check, trie.row, trie.digits


def _safe_windows(ids: np.ndarray, length: int, shorter: Trie | None, whole: bool) -> np.ndarray:
    """Where windows of ``length`` words start whose first, and if ``whole`` also last, ``length - 1`` words the trie has."""
    if shorter is None:
        return np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
    found = shorter.ends(ids, length - 1) >= 0
    after = found[1:] if whole else ids[length - 1 :] > 0
    return np.flatnonzero(found[: len(after)] & after)


def _hashes(ids: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    h = np.zeros(len(at), np.uint64)
    for i in range(length):
        h = mix64(h ^ (ids[at + i].astype(np.uint64) + GOLDEN))
    return h


def _bits(numbers: np.ndarray, size: int) -> np.ndarray:
    """``size`` bits in bytes, the highest first, of which those of the ``numbers`` are set."""
    bits = np.zeros(size >> 3, np.uint8)
    np.bitwise_or.at(bits, numbers >> 3, (128 >> (numbers & 7)).astype(np.uint8))
    return bits


def _numbers(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    for ids in batch.column(0).to_pylist():
        yield np.frombuffer(ids, "<i4").astype(np.int64)


def _candidates(corpus: DataFrame, length: int, shorter: list[np.ndarray], total: int, least: int, scratch: Scratch) -> DataFrame:
    """``key`` of every phrase of ``length`` words that can occur ``least`` times.

    ``shorter`` are the parts of the frequent phrases of one word less, none for ``length`` 2. If there are several, only
    the first words of a window are looked up, in one part after the other: fewer windows are ruled out, none is lost.
    The hash buckets are at least a 16th of the corpus's words; beyond ``BUCKETS`` they are dealt with in several passes,
    which is to be rare, as each pass looks up all windows again.
    """
    context = corpus.sparkSession.sparkContext
    wanted = 1 << max(10, (total // 16).bit_length())
    buckets, slices = min(wanted, BUCKETS), max(1, wanted // BUCKETS)
    pieces = max(64, buckets >> 16)
    tables = []
    for part in shorter or [None]:
        trie = context.broadcast(None if part is None else _trie_arrays(part))
        whole = len(shorter) == 1
        for slice_ in range(slices):

            def windows(ids: np.ndarray, held: Any = trie, this: int = slice_, test: bool = whole) -> tuple[np.ndarray, np.ndarray]:
                at = _safe_windows(ids, length, held.value and Trie(*held.value), test)
                h = _hashes(ids, at, length)
                if slices > 1:
                    mine = (h >> np.uint64(32)) % np.uint64(slices) == this
                    at, h = at[mine], h[mine]
                return at, (h & np.uint64(buckets - 1)).astype(np.int64)

            def sums(batches: Iterator[pa.RecordBatch], windows: Any = windows) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    for ids in _numbers(batch):
                        bucket, n = np.unique(windows(ids)[1], return_counts=True)
                        yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(n)], names=["bucket", "n"])

            summed = corpus.mapInArrow(sums, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
            heavy = summed.where(F.col("n") >= least).select("bucket").toArrow().column("bucket").to_numpy()
            bits = context.broadcast(_bits(heavy, buckets).tobytes())

            kind = "<i8" if length == 2 else f"V{4 * length}"  # integers are sorted faster

            def distinct(batches: Iterator[pa.RecordBatch], windows: Any = windows, bits: Any = bits) -> Iterator[pa.RecordBatch]:
                heavy = np.frombuffer(bits.value, np.uint8)
                seen, held, size = np.zeros(0, kind), [], 0
                for batch in batches:
                    for ids in _numbers(batch):
                        at, bucket = windows(ids)
                        at = at[heavy[bucket >> 3] & (128 >> (bucket & 7)) > 0]
                        held.append(np.unique(ids[at[:, None] + np.arange(length)].astype("<i4").view(kind).ravel()))
                        size += len(held[-1])
                        if size >= max(_HELD, len(seen)):
                            seen, held, size = np.unique(np.concatenate([seen, *held])), [], 0
                seen = np.unique(np.concatenate([seen, *held]))
                words = seen.view("<i4").astype(np.int64)
                bucket = (_hashes(words, np.arange(0, len(words), length), length) & np.uint64(buckets - 1)).astype(np.int64)
                piece = bucket * pieces // buckets
                order = np.argsort(piece, kind="stable")
                parts = np.split(order, np.flatnonzero(np.diff(piece[order])) + 1) if len(seen) else []
                rows = [pa.array([int(piece[part[0]]) for part in parts], pa.int64()), pa.array([seen[part].tobytes() for part in parts], pa.binary())]
                yield pa.RecordBatch.from_arrays(rows, names=["piece", "keys"])

            def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                seen: dict[int, np.ndarray] = {}
                for batch in batches:
                    for number, keys in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                        seen[number] = np.unique(np.append(seen.get(number, np.zeros(0, kind)), np.frombuffer(keys, kind)))
                for keys in seen.values():
                    yield pa.RecordBatch.from_arrays([pa.array([k.tobytes() for k in keys], pa.binary())], names=["key"])

            # A task's windows are sets by range of buckets, which are then united: rows do not grow with tasks times windows.
            sets = corpus.coalesce(_TASKS * context.defaultParallelism).mapInArrow(distinct, "piece long, keys binary")
            tables.append(scratch.stage(sets.repartition("piece").mapInArrow(merge, "key binary"), "candidates"))
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table)
    return out


def _counted(corpus: DataFrame, candidates: DataFrame, length: int, least: int, scratch: Scratch) -> DataFrame:
    """``key, n`` of the candidates that occur ``least`` times, counted by tries of ``TRIE`` candidates each.

    The counts of a task are one array, cut into pieces of ``_PIECE`` candidates whose arrays are then added up. There are
    a few tasks per core, not one per block, so what is added up does not grow with the corpus.
    """
    context = corpus.sparkSession.sparkContext
    tables = []
    for part in _parts(candidates, TRIE):
        keys = _keys(part, length)
        shared = context.broadcast((_trie_arrays(keys), keys.astype("<i4")))

        def count(batches: Iterator[pa.RecordBatch], shared: Any = shared) -> Iterator[pa.RecordBatch]:
            arrays, keys = shared.value
            trie = Trie(*arrays)
            total = np.zeros(len(keys), np.int64)
            for batch in batches:
                for ids in _numbers(batch):
                    rows = trie.ends(ids, length)
                    total += np.bincount(rows[rows >= 0], minlength=len(keys))
            pieces = range(0, len(keys), _PIECE)
            counts = [total[start : start + _PIECE].astype("<i8").tobytes() for start in pieces]
            yield pa.RecordBatch.from_arrays([pa.array(pieces, pa.int64()), pa.array(counts, pa.binary())], names=["start", "counts"])

        def add(batches: Iterator[pa.RecordBatch], shared: Any = shared) -> Iterator[pa.RecordBatch]:
            keys, total = shared.value[1], {}
            for batch in batches:
                for start, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    total[start] = total.get(start, 0) + np.frombuffer(counts, "<i8")
            for start, counts in total.items():
                hit = np.flatnonzero(counts >= least)
                yield pa.RecordBatch.from_arrays([pa.array([keys[start + i].tobytes() for i in hit], pa.binary()), pa.array(counts[hit])], names=["key", "n"])

        tasks = corpus.coalesce(_TASKS * context.defaultParallelism).mapInArrow(count, "start long, counts binary")
        tables.append(scratch.stage(tasks.repartition("start").mapInArrow(add, "key binary, n long"), "phrases"))
    if not tables:
        return corpus.sparkSession.createDataFrame([], "key binary, n long")
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table)
    return out


_PHRASE = "key binary, n long, lang string, phrase string, last string, lefts array<long>, rights array<long>"


def _described(phrases: DataFrame, shorter: DataFrame, length: int, scratch: Scratch) -> DataFrame:
    """``phrases`` with their language, text, last word, and how often their first and last 1, 2, ... words occur.

    All of it is known of the frequent phrases of one word less; parts of those are broadcast, one after the other, and looked up by trie.
    """
    context = phrases.sparkSession.sparkContext
    size = shorter.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("phrase")), F.lit(0))).first()
    bound = max(1, min(_TEXTS, size[0] * _TEXT_BYTES // max(size[1], 1)))
    empty = [F.lit(None).cast(t).alias(c) for c, t in (f.split(" ") for f in _PHRASE.split(", ")[2:])]
    out = phrases.select("key", "n", *empty)
    for part in _parts(shorter, bound):
        rows = part.toArrow().to_pylist()
        keys = np.frombuffer(b"".join(r["key"] for r in rows), "<i4").reshape(-1, length - 1).astype(np.int64)
        known = [(r["n"], r["lang"], r["phrase"], r["last"], r["lefts"], r["rights"]) for r in rows]
        shared = context.broadcast((_trie_arrays(keys), known))

        def fill(batches: Iterator[pa.RecordBatch], shared: Any = shared) -> Iterator[pa.RecordBatch]:
            arrays, known = shared.value
            trie = Trie(*arrays)
            for batch in batches:
                table = batch.to_pylist()
                ids = np.frombuffer(b"".join(r["key"] for r in table), "<i4").reshape(-1, length).astype(np.int64)
                first = trie.ends(np.ascontiguousarray(ids[:, :-1]).ravel(), length - 1)[:: length - 1] if len(ids) else []
                last = trie.ends(np.ascontiguousarray(ids[:, 1:]).ravel(), length - 1)[:: length - 1] if len(ids) else []
                for row, i, j in zip(table, first, last):
                    if i >= 0:
                        n, row["lang"], row["phrase"], _, lefts, _ = known[i]
                        row["lefts"] = [*lefts, n]
                    if j >= 0:
                        n, _, _, row["last"], _, rights = known[j]
                        row["rights"] = [*rights, n]
                yield pa.RecordBatch.from_pylist(table, schema=batch.schema)

        out = scratch.stage(out.mapInArrow(fill, _PHRASE), "described")
    return out.withColumn("phrase", F.concat_ws(" ", "phrase", "last"))


def _with_totals(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """``phrases`` with the number of all words of their language."""
    totals = totals.select("lang", F.col("n").alias("words"))
    if totals.limit(BROADCAST_LANGS + 1).count() <= BROADCAST_LANGS:
        return phrases.join(F.broadcast(totals), "lang")
    salted = totals.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    rows = phrases.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(_SALTS)).cast("int"))
    return rows.join(salted, ["lang", "salt"]).drop("salt")


def scored(phrases: DataFrame, length: int, totals: DataFrame) -> DataFrame:
    """``lang, phrase, a, l, r, n, score`` of phrases of ``length`` words, in decimals: products may have 38 digits."""
    product = "cast(n as decimal(19,0)) * cast(words as decimal(19,0)) * 1000"
    cuts = [
        f"struct(({product}) div (cast(lefts[{k - 1}] as decimal(19,0)) * cast(rights[{length - k - 1}] as decimal(19,0))) as score, "
        f"{k} as cut, lefts[{k - 1}] as l, rights[{length - k - 1}] as r)"
        for k in range(1, length)
    ]
    best_cut = F.expr(f"array_min(array({', '.join(cuts)}))")
    chosen = _with_totals(phrases, totals).withColumn("best", best_cut)
    return chosen.select("lang", "phrase", F.col("n").alias("a"), "best.l", "best.r", F.col("words").alias("n"), "best.score")


def mine(
    docs: DataFrame, least: int = 100, longest: int = 5, inside: int = 100, text_column: str = "text", lang_column: str = "lang"
) -> DataFrame:
    """All collocations: ``lang, phrase, a, l, r, n, score``, one row per phrase of 2 to ``longest`` words with ``a >= least``.

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends and those into words at blanks and tabs. ``a`` is
    how often the words occur one after the other within a piece, ``n`` the number of all words of the language. Of the cuts of a phrase into
    two parts, which occur ``l`` and ``r`` times, the one with the lowest ``score`` = floor(1000 * a * n / (l * r)) counts,
    and of equal ones the first. A phrase within a longer one that occurs in at least ``inside`` percent of its cases is left out.

    A null text is empty, a null language ``und``; an empty table gives no rows, repeated rows count each. Words and texts may be
    of any length. Other columns are not read. The result is a staged table.
    """
    scratch = Scratch()
    text, lang = F.coalesce(F.col(f"`{text_column}`"), F.lit("")), F.coalesce(F.col(f"`{lang_column}`"), F.lit("und"))
    rows = docs.select(lang.alias("lang"), text.alias("text"))
    counts = scratch.stage(_word_counts(rows).where(F.col("word").isNull() | (F.col("n") >= least)), "words")
    totals = counts.where("word is null").select("lang", "n")
    words = _numbered(counts.where("word is not null"), scratch)
    total = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    corpus = scratch.stage(_encoded(rows, words), "numbers")

    def little_endian(i: Any) -> Any:
        return F.concat(*[F.substring(F.to_binary(F.lpad(F.hex(i), 8, "0"), F.lit("hex")), 4 - b, 1) for b in range(4)])

    none = F.array().cast("array<long>")
    level = words.select(little_endian(F.col("id")).alias("key"), "n", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), none.alias("lefts"), none.alias("rights"))
    levels = []
    for length in range(2, longest + 1):
        shorter = [_keys(p, length - 1) for p in _parts(level, TRIE)] if length > 2 else []
        if length > 2 and not shorter:
            break
        candidates = _candidates(corpus, length, shorter, total, least, scratch)
        phrases = _counted(corpus, candidates, length, least, scratch)
        level = _described(phrases, level, length, scratch)
        levels.append(level)

    tables = []
    for i, level in enumerate(levels):
        length = i + 2
        if i + 1 < len(levels):
            # A phrase in a longer one that takes its place is also in one of just one word more that does.
            longer = levels[i + 1]
            parts = [longer.select(F.substring("key", 1 + 4 * skip, 4 * length).alias("key"), F.col("n").alias("longer")) for skip in (0, 1)]
            most = parts[0].unionByName(parts[1]).groupBy("key").agg(F.max("longer").alias("longer"))
            level = level.join(most, "key", "left").where(F.coalesce(100 * F.col("longer") < inside * F.col("n"), F.lit(True)))
        tables.append(scored(level, length, totals))
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table)
    result = stage(out, "collocations")
    scratch.drop()
    return result


def best(collocations: DataFrame, most: int = 2000) -> DataFrame:
    """The first ``most`` of each language by score, then ``a`` (both descending), then phrase, with their ``rank`` from 1.

    Each language is cut down in ``_SALTS`` places first, so a task gets no more than as many times ``most`` rows of it.
    """
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    salted = collocations.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(_SALTS)))
    first = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= most)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= most).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
