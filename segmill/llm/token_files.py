"""Token ids in files: Simple-8b words in blocks, documents in ascending order of their id.

A 64-bit word holds a selector in its upper four bits and as many equally wide ids as fit
the other 60. Ids that no width takes are written as ``ESCAPE`` and kept beside the words. A
document starts with a new word, so each can be decoded alone: a block lists for every
document where its words, its ids and its escapes begin.

The files are Parquet, one row per block: written by Spark's own commit protocol they lie in any
store that Spark reaches, a lost task leaves nothing half-written, and any Parquet reader gives
the words to ``unpack``. Within a file, and from file to file, documents ascend.
"""

from __future__ import annotations

import json
import os
import sys
import zlib
from collections.abc import Iterator
from itertools import chain, repeat
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the format: ids per word and bits per id, by selector. The first two are runs of zeros.
COUNTS = (240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
WIDTHS = (0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
ESCAPE = (1 << 60) - 1

#: A block is closed by the document with which it has this many ids, so it holds that and one document more at most.
BLOCK_IDS = 65_536
#: Pieces of text whose ids a task remembers, and the length up to which it does.
_REMEMBERED, _SHORT = 500_000, 40
#: Fixed value: how byte-level vocabularies write a blank.
_BLANK = "\u0120"
#: Marks that are told apart from a word before them, and the end of the letters for which that is done.
_TAIL, _LATIN = ".,;:!?$%", "\u0250"
#: So many documents are cheaper to follow one by one than side by side.
_FEW = 16
#: Bytes of text that are encoded at once.
_CHUNK = 16_000_000

_SHIFT, _MASK = np.uint64(60), np.uint64(ESCAPE)
#: Smallest numbers that need each width, the place among them by number and the widest place that a count allows, and selectors by count.
_LEAST = np.array([0] + [1 << w for w in WIDTHS[1:-1]], np.uint64)
_NARROW = (np.searchsorted(_LEAST, np.arange(1 << 16, dtype=np.uint64), "right") - 1).astype(np.uint8)
_WIDEST = {c: int(np.searchsorted(_LEAST, np.uint64((1 << w) - 1), "right")) - 1 for c, w in zip(COUNTS, WIDTHS)}
_SELECTOR = np.zeros(256, np.uint8)
_SELECTOR[list(COUNTS)] = range(len(COUNTS))


def _starts(step: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where words begin: at the start of every document, and ``step`` of the place behind each word's start.

    Documents are followed side by side, the last few one by one.
    """
    begins = np.zeros(len(step), bool)
    stop = np.asarray(ends, np.int64)
    at = stop - np.diff(stop, prepend=0)
    while True:
        open_ = at < stop
        if not open_.all():
            at, stop = at[open_], stop[open_]
        if len(at) < max(_FEW, 1):
            break
        begins[at] = True
        at = at + step[at]
    for first, last in zip(at.tolist(), stop.tolist()):
        places, place, hops = [], 0, step[first:last].tolist()
        while place < last - first:
            places.append(place)
            place += hops[place]
        begins[first + np.array(places, np.int64)] = True
    return np.flatnonzero(begins)


def pack(ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of ``ids`` (unsigned 64-bit), how many of them each document takes, and the escaped ids.

    ``ends`` are the places at which documents end, ascending; each starts with a new word. Every
    word takes as many of the next ids as any selector can, so it depends on nothing behind them.
    """
    n = len(ids)
    escapes = ids[ids >= _MASK]
    plain = np.minimum(ids, _MASK)
    narrow = np.zeros(n + 8, np.uint8)  # the narrowest of _LEAST that an id fits
    narrow[:n] = _NARROW[plain] if n and int(plain.max()) < len(_NARROW) else np.searchsorted(_LEAST, plain, "right") - 1
    left = np.minimum(np.repeat(ends, np.diff(ends, prepend=0)) - np.arange(n), 255).astype(np.uint8)  # ids left in the document
    # Who fits a count fits every smaller one. Counts up to 8 are tried at all places, larger ones where the one before fits.
    step, widest = np.ones(n, np.uint8), narrow[:n].copy()
    for count in range(2, 9):
        np.maximum(widest, narrow[count - 1 : count - 1 + n], out=widest)
        step[(widest <= _WIDEST[count]) & (left >= count)] = count
    open_, done = np.flatnonzero(step == 8), 8
    for count in (10, 12, 15, 20, 30, 60, 120, 240):
        open_ = open_[left[open_] >= count]
        for ahead in range(done, count):
            widest[open_] = np.maximum(widest[open_], narrow[open_ + ahead])
        open_, done = open_[widest[open_] <= _WIDEST[count]], count
        step[open_] = count
    starts = _starts(step, ends)
    used = _SELECTOR[step[starts]]
    words = used.astype(np.uint64) << _SHIFT
    for s, (count, width) in enumerate(zip(COUNTS, WIDTHS)):
        if width and (hit := np.flatnonzero(used == s)).size:
            group = plain[starts[hit][:, None] + np.arange(count)]
            words[hit] |= np.bitwise_or.reduce(group << (np.arange(count) * width).astype(np.uint64), axis=1)
    return words, np.diff(np.searchsorted(starts, ends), prepend=0), escapes


def unpack(words: np.ndarray, escapes: np.ndarray) -> np.ndarray:
    """The ids that ``pack`` was given."""
    used = (words >> _SHIFT).astype(np.int64)
    counts = np.array(COUNTS)[used]
    starts = np.cumsum(counts) - counts
    ids = np.zeros(int(counts.sum()), np.uint64)
    for s, (count, width) in enumerate(zip(COUNTS, WIDTHS)):
        if width and (hit := np.flatnonzero(used == s)).size:
            shifts = (np.arange(count) * width).astype(np.uint64)
            ids[starts[hit][:, None] + np.arange(count)] = (words[hit][:, None] >> shifts) & np.uint64((1 << width) - 1)
    if len(escapes):
        ids[ids == _MASK] = escapes
    return ids


class Encoder:
    """Ids of whole texts by a ``tokenizers`` file. Strings of special tokens in a text are ordinary text.

    Where the tokenizer cuts its text by the byte-level pattern, a single blank between two
    characters that are not white space always begins a new piece, and so do marks of ``_TAIL`` after a
    letter. Texts whose blanks are all of that kind are cut there first and every piece is encoded once, with the ids
    that it has in the whole text. Other texts, and all texts of other tokenizers, are encoded as they are.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, CharDelimiterSplit

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        cutter = parts.get("pre_tokenizer") or {}
        self.cuts = parts.get("normalizer") is None and cutter.get("type") == "ByteLevel" and cutter.get("use_regex") and not cutter.get("add_prefix_space")
        self.known: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        # A word of letters is one piece: written byte by byte as in the vocabulary, the model alone encodes it.
        self.letters = Tokenizer(self.tokenizer.model)
        self.letters.pre_tokenizer = CharDelimiterSplit(" ")
        written = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.written = {i: written(chr(i))[0][0] for i in range(128, ord(_LATIN))}
        self.opens = np.zeros(max(vocabulary.values(), default=0) + 1, bool)  # ids that begin with a blank
        self.opens[[i for token, i in vocabulary.items() if token.startswith(_BLANK)]] = True

    def _encode(self, texts: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in encoded]

    def _encode_words(self, words: list[str], letters: bool) -> list[bytes]:
        """Ids of pieces without blanks, each with one before: encoded as one text, they part at the blanks."""
        out: list[bytes] = []
        for start in range(0, len(words), 50_000):
            some = words[start : start + 50_000]
            if letters:
                spelt = [w if w.isascii() else w.translate(self.written) for w in some]
                encoded = self.letters.encode_batch_fast([_BLANK + f" {_BLANK}".join(spelt)], add_special_tokens=False)
                raw = np.array(encoded[0].ids, "<u4").tobytes()
            else:
                raw = self._encode([" " + " ".join(some)])[0]
            at = (4 * np.flatnonzero(self.opens[np.frombuffer(raw, "<u4")])).tolist()
            out += [raw[a:b] for a, b in zip(at, [*at[1:], len(raw)])]
        return out

    def _learn(self, pieces: list[str], again: list[bool]) -> list[bytes]:
        """The ids of every piece with a blank before it; short ones that are met ``again`` are remembered."""
        if len(self.known) > _REMEMBERED:
            self.known = {}
        stems = [p.rstrip(_TAIL) for p in pieces]
        stems = [s if s.isalpha() and (s.isascii() or max(s) < _LATIN) else p for p, s in zip(pieces, stems)]
        new = {s for s in stems if s not in self.known}
        letters = [p for p in new if p.isalpha() and (p.isascii() or max(p) < _LATIN)]
        others = list(new.difference(letters))
        fresh = dict(zip(letters, self._encode_words(letters, True), strict=True))
        fresh.update(zip(others, self._encode_words(others, False), strict=True))
        tails = list({p[len(s) :] for p, s in zip(pieces, stems)})
        tail = dict(zip(tails, self._encode(tails)))
        known = self.known
        found = [(fresh.get(s) or known[s]) + tail[p[len(s) :]] for p, s in zip(pieces, stems)]
        self.known.update((p, ids) for p, ids, a in zip(pieces, found, again) if a and len(p) <= _SHORT)
        return found

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts (none of them null), one text after the other, and how many each has."""
        if not self.cuts:
            encoded = self._encode(texts.to_pylist())
            return np.frombuffer(b"".join(encoded), "<u4"), np.array([len(x) // 4 for x in encoded], np.int64)
        cut = pc.split_pattern(texts, " ")
        heads = cut.offsets.to_numpy()[:-1] - cut.offsets[0].as_py()
        coded = cut.flatten().dictionary_encode()
        pieces, which = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)
        pool = list(map(self.known.get, pieces))
        new = [i for i, ids in enumerate(pool) if ids is None]
        odd = [i for i in new if not (p := pieces[i]) or p.strip() != p]
        irregular = np.zeros(len(pieces) + 1, bool)
        irregular[odd] = True
        whole = np.logical_or.reduceat(irregular[which], heads)
        new = [i for i in new if not irregular[i]]
        again = (np.bincount(which, minlength=len(pieces)) > 1).tolist()
        for i, ids in chain(zip(odd, repeat(b"")), zip(new, self._learn([pieces[i] for i in new], [again[i] for i in new]))):
            pool[i] = ids
        # The first piece has no blank before it; a text that is not cut has all its ids there.
        first = self._encode([texts[i].as_py() if w else pieces[which[h]] for i, (h, w) in enumerate(zip(heads.tolist(), whole.tolist()))])
        which[np.repeat(whole, np.diff(heads, append=len(which)))] = len(pieces)
        which[heads] = np.arange(len(heads)) + len(pieces) + 1
        pool = [*pool, b"", *first]
        sizes = np.fromiter(map(len, pool), np.int64, len(pool)) // 4
        starts, taken = np.cumsum(sizes) - sizes, sizes[which]
        ends = np.cumsum(taken)
        at = np.repeat(starts[which] - ends + taken, taken) + np.arange(ends[-1])
        return np.frombuffer(b"".join(pool), "<u4")[at], np.add.reduceat(taken, heads)


def _encoder(path: str) -> Encoder:
    """The encoder of this worker process: what it remembers serves all its tasks."""
    held = sys.modules.setdefault("segmill_encoders", ModuleType("segmill_encoders")).__dict__
    if path not in held:
        held[path] = Encoder(path)
    return held[path]


def _schema(id_type: T.DataType) -> T.StructType:
    fields = [
        ("shard", T.IntegerType()), ("block", T.IntegerType()), ("first", T.LongType()), ("doc_ids", T.ArrayType(id_type)),
        ("lengths", T.ArrayType(T.LongType())), ("word_counts", T.ArrayType(T.LongType())), ("escape_counts", T.ArrayType(T.LongType())),
        ("words", T.BinaryType()), ("escapes", T.BinaryType()),
    ]
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in parts of about ``_CHUNK`` bytes of text, one row at least."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column(1)).to_numpy()) if batch.num_rows else np.array([])
        start = 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + _CHUNK, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, shards: int | None = None, id_column: str = "doc_id", text_column: str = "text"
) -> None:
    """Encode every whole text, append ``end_id`` and write the ids at ``path`` in ascending order of ``id_column``.

    ``shards`` files (by default the session's shuffle partitions) take ranges of documents of about equal number. Null
    ids come first, rows of one id in order of a hash of their texts; then, and for equal rows, of their place in the
    table, so that not even rows of one id have to go to one task. A null text counts as empty and becomes the end
    id alone; an empty table gives files without blocks. Other columns are not read. A task
    holds the texts of an Arrow batch and two blocks; a text of any length is encoded whole.
    """
    spark = docs.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(docs[f"`{text_column}`"], F.lit(""))
    rows = docs.select(docs[f"`{id_column}`"].alias("doc_id"), text.alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("place")]
    rows = rows.withColumn("place", F.monotonically_increasing_id()).repartitionByRange(shards, *order)
    rows = rows.sortWithinPartitions(*order).select("doc_id", "text")
    schema = _schema(rows.schema["doc_id"].dataType)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        encode, shard, arrow = _encoder(tokenizer), TaskContext.get().partitionId(), to_arrow_schema(schema)
        block, first = 0, 0
        names, lengths, values = [], np.zeros(0, np.int64), np.zeros(0, np.uint64)

        def closed(count: int) -> pa.RecordBatch:
            """The first ``count`` of the documents that are held, as a block."""
            nonlocal block, first, names, lengths, values
            keys, ends = pa.concat_arrays(names), np.cumsum(lengths[:count])
            taken = values[: ends[-1]]
            words, word_counts, escapes = pack(taken, ends)
            escaped = np.add.reduceat(taken >= _MASK, ends - lengths[:count], dtype=np.int64)
            row = [shard], [block], [first], [keys.slice(0, count).to_pylist()], [lengths[:count]], [word_counts], [escaped]
            row = pa.RecordBatch.from_arrays([*map(pa.array, row), pa.array([words.astype("<u8").tobytes()]), pa.array([escapes.astype("<u8").tobytes()])], names=arrow.names)
            block, first = block + 1, first + len(taken)
            names, lengths, values = [keys.slice(count)], lengths[count:], values[len(taken) :]
            return row.cast(arrow)

        for batch in _chunks(batches):
            ids, counts = encode(batch.column(1))
            ended = np.full(len(ids) + len(counts), end_id, np.uint64)
            ended[np.arange(len(ids)) + np.repeat(np.arange(len(counts)), counts)] = ids
            names.append(batch.column(0))
            lengths, values = np.append(lengths, counts + 1), np.append(values, ended)
            while (full := int(np.searchsorted(np.cumsum(lengths), BLOCK_IDS))) < len(lengths):
                yield closed(full + 1)
        if len(lengths):
            yield closed(len(lengths))

    rows.mapInArrow(blocks, schema).write.option("compression", "zstd").parquet(path)


def read_tokens(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """The documents of the files at ``path``: ``doc_id, start, n_tokens, ids_crc32`` and, if asked for, the ``ids``.

    ``start`` counts the ids of all documents before; the driver adds up one number per file for it.
    ``ids_crc32`` is that of the ids as little-endian unsigned 32-bit integers. Blocks are decoded where they are read, nothing is shuffled.
    """
    files = spark.read.parquet(path)
    totals = {r.shard: r.n for r in files.groupBy("shard").agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n")).collect()}
    before, count = {}, 0
    for shard in sorted(totals):
        before[shard], count = count, count + totals[shard]
    id_type = files.schema["doc_ids"].dataType.elementType
    fields = [T.StructField("doc_id", id_type)] + [T.StructField(c, T.LongType()) for c in ("start", "n_tokens", "ids_crc32")]
    schema = T.StructType(fields + [T.StructField("ids", T.ArrayType(T.LongType()))] * ids)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                values = unpack(np.frombuffer(row["words"].as_py(), "<u8"), np.frombuffer(row["escapes"].as_py(), "<u8"))
                lengths = row["lengths"].values.to_numpy()
                ends = np.cumsum(lengths)
                raw = values.astype("<u4").tobytes()
                crcs = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip((ends - lengths).tolist(), ends.tolist())]
                starts = ends - lengths + row["first"].as_py() + before[row["shard"].as_py()]
                columns = [row["doc_ids"].values, pa.array(starts), pa.array(lengths), pa.array(crcs, pa.int64())]
                if ids:
                    columns.append(pa.ListArray.from_arrays(np.append([0], ends).astype(np.int32), values.astype(np.int64)))
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return files.drop("block", "word_counts", "escape_counts").mapInArrow(documents, schema)


def read_document(block: dict, number: int) -> np.ndarray:
    """The ids of the document at ``number`` of a block (a row of the files as a dict), without decoding the others."""
    word, escape = sum(block["word_counts"][:number]), sum(block["escape_counts"][:number])
    words = np.frombuffer(block["words"], "<u8")[word : word + block["word_counts"][number]]
    return unpack(words, np.frombuffer(block["escapes"], "<u8")[escape : escape + block["escape_counts"][number]])
