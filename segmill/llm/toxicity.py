"""Toxicity scores: logistic regression over hashed n-grams, fitted by FTRL-proximal.

Words, their stems (the first STEM letters of longer words), pairs of neighbours and
pairs with one or two words between are hashed into 2**BITS coordinates. Every coordinate has its own learning rate, and the L1 term keeps
most weights at zero, so the model is a short list of (coordinate, weight). A document's
features are the distinct coordinates it holds, taken from its whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmill.llm.common import GOLDEN, mix64
from segmill.llm.labelled import training_texts

#: Labelled documents used for fitting, at most. They meet in one task.
SAMPLE_ROWS = 16_000
BITS, STEM = 20, 5
ALPHA, BETA, L1, L2, EPOCHS = 1.0, 1.0, 6.0, 1.0, 3
THRESHOLD = 0.3

_BASE = np.uint64(0x100000001B3)  # odd, so it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _grown(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse up to ``n``."""
    if len(_powers[0]) < n:
        size = 1 << max(12, (n - 1).bit_length())
        for i, base in enumerate((_BASE, _INVERSE)):
            table = np.full(size, base)
            table[0] = 1
            _powers[i] = np.multiply.accumulate(table)
    return _powers[0], _powers[1]


def _is_word(codes: np.ndarray) -> np.ndarray:
    """ASCII letters and digits, and everything beyond Latin-1 punctuation and general punctuation."""
    ascii_word = ((codes >= 97) & (codes <= 122)) | ((codes >= 48) & (codes <= 57)) | (codes == 95) | ((codes >= 65) & (codes <= 90))
    return ascii_word | ((codes >= 0xC0) & ~((codes >= 0x2000) & (codes <= 0x206F)) & ~((codes >= 0x3000) & (codes <= 0x303F)))


def word_hashes(text: str) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word of the lower-cased text, in order, and of the stems of the long ones."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = np.zeros(len(codes) + 2, np.int8)
    inside[1:-1] = _is_word(codes)
    change = np.diff(inside)
    starts, ends = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    power, inverse = _grown(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * power[: len(codes)], out=sums[1:])

    def between(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix64((sums[b] - sums[a]) * inverse[a] + (b - a).astype(np.uint64) * GOLDEN)

    long = starts[ends - starts > STEM]
    return between(starts, ends), between(long, long + STEM)


def coordinates(text: str | None, bits: int = BITS) -> np.ndarray:
    """Distinct hashed coordinates of words, stems, neighbours and skip-grams of a whole text."""
    h, stems = word_hashes(text) if text else (np.zeros(0, np.uint64),) * 2
    grams = [h, mix64(stems + GOLDEN)]
    for gap in (1, 2, 3):
        if len(h) > gap:
            grams.append(mix64(h[:-gap] * np.uint64(2 * gap + 1) + h[gap:] + GOLDEN // np.uint64(gap + 1)))
    return np.unique((mix64(np.concatenate(grams)) >> np.uint64(64 - bits)).astype(np.int32))


@dataclass(frozen=True)
class Weights:
    """The coordinates with a weight, in order, and the intercept."""

    index: np.ndarray
    weight: np.ndarray
    intercept: float

    def score(self, at: np.ndarray) -> float:
        margin = self.intercept
        if len(self.index):
            found = np.searchsorted(self.index, at)
            found[found == len(self.index)] = 0
            margin += self.weight[found][self.index[found] == at].sum()
        return float(1 / (1 + np.exp(-np.clip(margin, -500, 500))))


def ftrl(examples: list[tuple[np.ndarray, int]], bits: int = BITS, epochs: int = EPOCHS) -> Weights:
    """One pass over the examples per epoch, in the order given. The intercept is not regularised."""
    size = 1 << bits
    z, n, bias_z, bias_n, bias = np.zeros(size), np.zeros(size), 0.0, 0.0, 0.0
    share = (sum(y for _, y in examples) + 0.5) / (len(examples) + 1.0)
    start = float(np.log(share / (1 - share)))

    def weights(at) -> np.ndarray:
        zz = z[at]
        return -np.sign(zz) * np.maximum(np.abs(zz) - L1, 0) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

    for _ in range(epochs):
        for at, y in examples:
            w = weights(at)
            g = 1 / (1 + np.exp(-np.clip(start + bias + w.sum(), -500, 500))) - y
            seen = n[at]
            z[at] += g - (np.sqrt(seen + g * g) - np.sqrt(seen)) / ALPHA * w
            n[at] = seen + g * g
            bias_z += g - (np.sqrt(bias_n + g * g) - np.sqrt(bias_n)) / ALPHA * bias
            bias_n += g * g
            bias = -bias_z / ((BETA + np.sqrt(bias_n)) / ALPHA)
    index = np.flatnonzero(np.abs(z) > L1)
    return Weights(index.astype(np.int32), weights(index), start + bias)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> Weights:
    """Fit on at most ``sample_rows`` labelled documents that are not held out, in one task; the driver gets the weights.

    Of an id with several texts one is taken, so repeated rows count once; null texts count as empty, null ids and labels other than 0
    and 1 not at all. Without labelled rows every text gets the score 0.5. Other columns are not read.
    """

    @F.pandas_udf("array<int>")
    def hashed(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([coordinates(t) for t in batch])

    def trained(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = [r for b in batches for r in zip(b["doc_id"], b["x"], b["label"], strict=True)]
        rows.sort(key=lambda r: mix64(np.array([r[0]], np.int64).view(np.uint64))[0])
        model = ftrl([(np.asarray(x, np.int64), int(y)) for _, x, y in rows])
        yield pd.DataFrame({"at": [-1, *model.index], "weight": [model.intercept, *model.weight]})

    sample = training_texts(docs, labels, label, sample_rows).select(F.col("doc_id").cast("long"), "label", hashed("text").alias("x"))
    fitted = sample.dropDuplicates(["doc_id"]).repartition(1).mapInPandas(trained, "at int, weight double").toPandas().sort_values("at")
    if fitted.empty:
        return Weights(np.zeros(0, np.int32), np.zeros(0), 0.0)
    return Weights(fitted["at"].to_numpy(np.int32)[1:], fitted["weight"].to_numpy(float)[1:], float(fitted["weight"].iloc[0]))


def score(text: Column, model: Weights, bits: int = BITS) -> Column:
    """Probability that a whole text of any length is toxic; a null text counts as empty, equal texts have equal scores."""

    @F.pandas_udf("double")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([model.score(coordinates(t, bits)) for t in batch], dtype=float)

    return scored(text)
