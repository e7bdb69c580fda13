"""Quality scores from histogram gradient-boosted trees over document statistics.

The statistics of a text are computed with numpy inside the tasks; the trees are fitted
on a bounded sample of labelled documents (only its numbers reach the driver) and
flattened into arrays, over which a whole batch of documents walks level by level.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmill.llm.labelled import training_texts

#: Labelled documents used for fitting, at most; a few MB of statistics.
SAMPLE_ROWS = 20_000
TREES, DEPTH, BINS = 80, 4, 64
LEARNING_RATE, L2, LEAST_HESSIAN = 0.15, 1.0, 1.0
THRESHOLD = 0.7

STATISTICS = [
    "log_chars", "log_words", "log_lines", "word_length", "word_length_spread", "letters", "capitals", "digits",
    "spaces", "marks", "exclamation", "bars", "symbols", "same_char", "distinct_words", "top_word", "word_again",
    "distinct_pairs", "marked_words", "repeated_lines", "words_per_line", "ended_lines", "char_entropy", "short_words",
]

_SYMBOLS = np.isin(np.arange(256), [ord(c) for c in "#$%&*+<=>@\\^_`{}~"])
_CODES = [chr(i) for i in range(256)]
_LETTER = np.array([c.isalpha() for c in _CODES])
_UPPER = np.array([c.isupper() for c in _CODES])
_DIGIT = np.array([c.isdigit() for c in _CODES])
_SPACE = np.array([c.isspace() for c in _CODES])


def statistics(text: str | None) -> np.ndarray:
    """The values of ``STATISTICS`` for a whole text; all zero for a null or empty one."""
    out = np.zeros(len(STATISTICS))
    if not text:
        return out
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    n = len(codes)
    small = np.minimum(codes, 255).astype(np.uint8)
    counts = np.bincount(small, minlength=256)
    counts[255] = 0  # characters beyond Latin-1, counted as letters below
    letters = counts[_LETTER].sum() + n - counts.sum()
    spaces = counts[_SPACE].sum()
    words = text.split()
    lines = [x for x in text.split("\n") if x.strip()]
    shares = counts[counts > 0] / n
    out[0], out[1], out[2] = np.log1p(n), np.log1p(len(words)), np.log1p(len(lines))
    out[5], out[6] = letters / n, counts[_UPPER].sum() / max(letters, 1)
    out[7], out[8] = counts[_DIGIT].sum() / n, spaces / n
    out[9] = (n - letters - spaces - counts[_DIGIT].sum()) / n
    out[10], out[11], out[12] = counts[33] / n, counts[124] / n, counts[_SYMBOLS].sum() / n
    if n > 2:
        same = codes[1:] == codes[:-1]
        out[13] = np.count_nonzero(same[1:] & same[:-1]) / n
    out[22] = -(shares * np.log(shares)).sum()
    if words:
        k = len(words)
        lengths = np.fromiter(map(len, words), np.int64, k)
        numbers: dict[str, int] = {}
        ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, k)
        pairs = ids[:-1] * len(numbers) + ids[1:]
        out[3], out[4] = lengths.mean(), lengths.std()
        out[14], out[15] = len(numbers) / k, np.bincount(ids).max() / k
        if k > 1:
            out[16] = np.count_nonzero(ids[1:] == ids[:-1]) / (k - 1)
            out[17] = len(np.unique(pairs)) / (k - 1)
        out[18] = sum(not (w[-1].isalnum() or w[-2:-1].isalnum() or len(w) == 1) for w in words) / k
        out[23] = np.count_nonzero(lengths <= 2) / k
        out[20] = k / len(lines)
    if lines:
        seen = Counter(lines)
        out[19] = 1 - len(seen) / len(lines)
        out[21] = sum(x.rstrip()[-1] in ".!?:;\"'" for x in lines) / len(lines)
    return out


@dataclass(frozen=True)
class Forest:
    """Complete trees as arrays: node i has the children 2i + 1 and 2i + 2; leaves fill the last level."""

    feature: np.ndarray  # (trees, inner nodes)
    cut: np.ndarray  # (trees, inner nodes): a value above it goes right
    leaf: np.ndarray  # (trees, leaves)
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities for the rows of ``x``, all trees and rows one level at a time."""
        trees, inner = self.feature.shape
        margin = np.full(len(x), self.base)
        if trees:
            which, rows = np.arange(trees)[:, None], np.arange(len(x))[None, :]
            node = np.zeros((trees, len(x)), np.int64)
            while node.size and node[0, 0] < inner:
                right = x[rows, self.feature[which, node]] > self.cut[which, node]
                node = 2 * node + 1 + right
            margin = margin + self.leaf[which, node - inner].sum(axis=0)
        return 1 / (1 + np.exp(-margin))


def _edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    inner = np.linspace(0, 1, bins + 1)[1:-1]
    return [np.unique(np.quantile(column, inner, method="nearest")) for column in x.T]


def fit_forest(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS) -> Forest:
    """Logistic boosting; each level's splits come from histograms of gradients by node and bin.

    With no rows or one class there are no trees and the score is the smoothed share of 1.
    """
    prior = (y.sum() + 0.5) / (len(y) + 1.0)
    base, inner = float(np.log(prior / (1 - prior))), 2**depth - 1
    empty = Forest(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)), base)
    if len(y) == 0 or y.min() == y.max():
        return empty
    edges = _edges(x, bins)
    binned = np.stack([np.searchsorted(e, column) for e, column in zip(edges, x.T, strict=True)])  # value > edge[b-1]
    feature, cut = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf)
    leaf, margin = np.zeros((trees, inner + 1)), np.full(len(y), base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            place = node - first
            total_g, total_h = (np.bincount(place, w, width) for w in (g, h))
            best = np.zeros(width)
            for f, column in enumerate(binned):
                key = place * bins + column
                left_g, left_h = (
                    np.bincount(key, w, width * bins).reshape(width, bins).cumsum(axis=1)[:, : len(edges[f])] for w in (g, h)
                )
                right_g, right_h = total_g[:, None] - left_g, total_h[:, None] - left_h
                gain = left_g**2 / (left_h + L2) + right_g**2 / (right_h + L2) - (total_g**2 / (total_h + L2))[:, None]
                gain[(left_h < LEAST_HESSIAN) | (right_h < LEAST_HESSIAN)] = 0
                if gain.shape[1]:
                    at = gain.argmax(axis=1)
                    better = gain[np.arange(width), at] > best + 1e-9
                    best = np.where(better, gain[np.arange(width), at], best)
                    feature[t, first : first + width][better] = f
                    cut[t, first : first + width][better] = edges[f][at[better]]
            right = x[np.arange(len(y)), feature[t, node]] > cut[t, node]
            node = 2 * node + 1 + right
        place = node - inner
        leaf[t] = -LEARNING_RATE * np.bincount(place, g, inner + 1) / (np.bincount(place, h, inner + 1) + L2)
        margin += leaf[t, place]
    return Forest(feature, cut, leaf, base)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Forest:
    """Fit on at most ``sample_rows`` labelled documents that are not held out.

    Of an id with several texts one is taken, so repeated rows count once; null texts count as empty, null ids and labels other than 0
    and 1 not at all. Without labelled rows, or with one label only, every text gets the smoothed share of 1. Other columns are not read.
    """

    @F.pandas_udf("array<double>")
    def measured(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([statistics(t) for t in batch])

    sample = training_texts(docs, labels, label, sample_rows)
    rows = sample.select("doc_id", "label", measured("text").alias("x")).dropDuplicates(["doc_id"]).orderBy("doc_id").toPandas()
    x = np.array(rows["x"].tolist(), float).reshape(len(rows), len(STATISTICS))
    return fit_forest(x, rows["label"].to_numpy(float))


def score(text: Column, forest: Forest) -> Column:
    """Probability that a whole text of any length is good; a null text counts as empty, equal texts have equal scores."""

    @F.pandas_udf("double")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            x = np.array([statistics(t) for t in batch]).reshape(len(batch), len(STATISTICS))
            yield pd.Series(forest.score(x))

    return scored(text)
