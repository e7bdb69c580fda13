"""Secrets in texts: fixed patterns, and strings that a battery of randomness tests picks out.

A candidate is a run of 20 or more characters of the usual encodings. Its encoding is
inferred from the characters it holds, and it is tested twice:

* Does it look random? The chi-squared statistic of its alphabet (in the form of its
  colliding pairs, of which it is a linear function; their moments hold for short strings
  too), the number of runs above and below the alphabet's middle, and the serial correlation of
  neighbours must all be what uniform draws give.
* Could ordinary text look like this? The null hypothesis is a string of characters with
  the frequencies, and changes between lower case, upper case and digits, of all words of
  all texts. It gives a p-value for the same chi-squared statistic and one for the runs
  of character classes; both grow sharper with length. Benjamini and Hochberg's rule
  decides within each class of lengths, over all candidates of the table, which
  p-values are small enough.

The p-values are rounded up to tenths of a decimal power, so the rule needs counts
per length class and step only.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmill.llm.common import bounded_batches, pack, unpack
from segmill.operators.staging import stage

# Fixed patterns of the contract.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KEYWORDS = ("passw", "secret", "token", "apikey", "api_key")
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ("assign", "access", "hex", "random")

#: False discoveries allowed among the spans that the tests add, per length class.
FALSE_SHARE = 0.01
#: A candidate is not random if one of the three tests gives less than this.
LEAST_RANDOM = 1e-4
#: Lower ends of the length classes.
LENGTHS = (20, 24, 32, 40, 64, 128)
STEPS = 4000  # tenths of a decimal power

_LONG = re.compile(r"[A-Za-z0-9+/_.=-]{20,}")
_RUN = re.compile(r"[A-Za-z0-9+/_-]{20,}")
_ALPHABETS = [
    (re.compile(r"[0-9a-f]+\Z"), "0123456789abcdef"),
    (re.compile(r"[0-9A-F]+\Z"), "0123456789ABCDEF"),
    (re.compile(r"[a-z]+\Z"), "abcdefghijklmnopqrstuvwxyz"),
    (re.compile(r"[A-Z]+\Z"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    (re.compile(r"[A-Z2-7]+\Z"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    (re.compile(r"[a-z0-9]+\Z"), "0123456789abcdefghijklmnopqrstuvwxyz"),
    (re.compile(r"[A-Z0-9]+\Z"), "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    (re.compile(r"[A-Za-z0-9]+\Z"), "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    (re.compile(r"[A-Za-z0-9+/]+\Z"), "+/0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    (re.compile(r""), "-_0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
]
_CLASS = np.array([0 if chr(c).islower() else 1 if chr(c).isupper() else 2 if chr(c).isdigit() else 3 for c in range(128)])
_WORDLIKE = np.array([chr(c).isalnum() for c in range(128)])


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, in order; matches never overlap within a kind."""
    found = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    for long in _LONG.finditer(text):
        found += [
            (m.start(), 2, m.end())
            for m in HEX.finditer(text, long.start(), long.end())
            if m.end() - m.start() >= LEAST["hex"]
        ]
    return sorted(found)


def _tail(z: float) -> float:
    """Upper tail of the normal distribution."""
    return 0.5 * math.erfc(z / math.sqrt(2))


def measure(token: str) -> tuple[int, int, int, float]:
    """Alphabet number, colliding pairs, changes of character class, and the smallest p of the tests for randomness."""
    which = next(i for i, (pattern, _) in enumerate(_ALPHABETS) if pattern.match(token))
    alphabet = _ALPHABETS[which][1]
    n, k = len(token), len(alphabet)
    place = {c: i for i, c in enumerate(alphabet)}
    x = np.array([place.get(c, 0) for c in token])
    counts = np.bincount(x, minlength=k)
    pairs, all_pairs = int((counts * (counts - 1) // 2).sum()), n * (n - 1) / 2
    spread = math.sqrt(all_pairs / k * (1 - 1 / k))
    uniform = 2 * _tail(abs(pairs - all_pairs / k) / spread)
    high = x >= k // 2
    ups = int(high.sum())
    downs = n - ups
    if ups and downs:
        expected = 2 * ups * downs / n + 1
        deviation = math.sqrt(max((expected - 1) * (expected - 2) / (n - 1), 1e-9))
        runs = 2 * _tail(abs(int((high[1:] != high[:-1]).sum()) + 1 - expected) / deviation)
    else:
        runs = 0.0
    centred = x - x.mean()
    power = float((centred**2).sum())
    serial = 2 * _tail(abs(float((centred[1:] * centred[:-1]).sum()) / power) * math.sqrt(n)) if power else 0.0
    kinds = _CLASS[np.frombuffer(token.encode(), np.uint8)]
    return which, pairs, int((kinds[1:] != kinds[:-1]).sum()), min(uniform, runs, serial)


def candidates(text: str, taken: list[tuple[int, int, int]]) -> list[list[float]]:
    """[start, end, alphabet, pairs, changes, p] of every candidate: what the fixed patterns leave of a run, in pieces of 20 or more."""
    out = []
    for long in _LONG.finditer(text):
        for m in _RUN.finditer(text, long.start(), long.end()):
            begin = m.start()
            for a, b in [*((a, b) for a, _, b in taken if a < m.end() and m.start() < b), (m.end(), m.end())]:
                for piece in _RUN.finditer(text, begin, max(begin, a)):
                    out.append([float(v) for v in (piece.start(), piece.end(), *measure(piece[0]))])
                begin = max(begin, b)
    return out


def _census(texts: pd.Series) -> np.ndarray:
    """Counts of the 128 ASCII characters in words, of neighbours in words, and of changes of class among these."""
    out = np.zeros(130, np.int64)
    for text in texts:
        if text:
            codes = np.frombuffer(text.encode("ascii", "replace"), np.uint8)
            word = _WORDLIKE[codes]
            out[:128] += np.bincount(codes[word], minlength=128)
            both = word[1:] & word[:-1]
            kinds = _CLASS[codes]
            out[128] += np.count_nonzero(both)
            out[129] += np.count_nonzero(both & (kinds[1:] != kinds[:-1]))
    return out


_FOUND = "n_assign long, n_access long, n_hex long, base string, tested array<array<double>>, census array<long>"


def _scan(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in texts:
        rows = []
        for text in batch:
            spans = base_spans(text) if text else []
            counts = [sum(kind == k for _, kind, _ in spans) for k in range(3)]
            base = ",".join(f"{KINDS[kind]}:{a}:{b}" for a, kind, b in spans)
            rows.append((*counts, base, candidates(text, spans) if text else []))
        frame = pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base", "tested"])
        frame["census"] = [_census(batch).tolist(), *[None] * (len(batch) - 1)] if len(batch) else []
        yield frame


class Ordinary:
    """What ordinary text would give, from the counts over all texts."""

    def __init__(self, census: np.ndarray):
        self.change = min(0.5, (census[129] + 1) / (census[128] + 100))
        self.moments = []
        for _, alphabet in _ALPHABETS:
            counts = np.array([census[ord(c)] for c in alphabet], float) + 0.5
            q = counts / counts.sum()
            self.moments.append(((q**2).sum(), (q**3).sum()))

    def step(self, n: int, alphabet: int, pairs: float, changes: float) -> int:
        """Tenths of a decimal power of the combined p-value, rounded towards less evidence."""
        two, three = self.moments[alphabet]
        c2, c3 = n * (n - 1) / 2, n * (n - 1) * (n - 2) / 6
        spread = math.sqrt(c2 * two * (1 - two) + 6 * c3 * max(three - two * two, 0))
        p = max(_tail((c2 * two - pairs) / max(spread, 1e-9)), 1e-300)
        share = changes / (n - 1)
        r = self.change
        log_q = 0.0
        if share > r:  # Chernoff's bound on the binomial tail
            log_q = -(n - 1) * (share * math.log(share / r) + ((1 - share) * math.log((1 - share) / (1 - r)) if share < 1 else 0))
        log_x = math.log(p) + log_q
        return min(STEPS, max(0, int(-10 * (log_x + math.log1p(-log_x)) / math.log(10))))


def length_class(n: int) -> int:
    return sum(n >= least for least in LENGTHS) - 1


def _cuts(counts: dict[tuple[int, int], int], share: float) -> dict[int, int]:
    """Per length class, the least step that Benjamini and Hochberg's rule lets through."""
    cuts = {}
    for k in {k for k, _ in counts}:
        steps = sorted((s for c, s in counts if c == k), reverse=True)
        total, passed = sum(counts[k, s] for s in steps), 0
        for s in steps:
            passed += counts[k, s]
            if 10 ** (-s / 10) <= share * passed / total:
                cuts[k] = s
    return cuts


def find_secrets(docs: DataFrame, text: str = "text", keep: list[str] | None = None, false_share: float = FALSE_SHARE) -> DataFrame:
    """Per document, its columns ``keep`` (all by default) and what was found in its whole text.

    ``n_assign``, ``n_access``, ``n_hex`` count the fixed patterns, ``n_random`` the strings
    added by the tests; ``base`` and ``spans`` list spans as kind:start:end (code points, end
    exclusive), joined by commas, in order of start and kind. Added spans never overlap
    a fixed pattern. A null text counts as empty; an empty table gives an empty one; every row, repeated or
    not, gives one row. Result columns replace kept ones of the same name.

    One pass over the texts. The driver gets 130 sums and the counts per length class and step.
    """
    bounded_batches(docs.sparkSession)
    keep = docs.columns if keep is None else keep
    kept = docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keep, text])])
    packed = pack(kept, found=F.pandas_udf(_scan, _FOUND)(kept[f"`{text}`"]))
    row = F.struct(*[F.col("row").getField(c).alias(c) for c in keep]).alias("row")
    found = stage(packed.select(row, "found.*"), "secrets")
    census = np.zeros(130, np.int64)
    for i, n in found.where("census is not null").select(F.posexplode("census").alias("i", "n")).groupBy("i").agg(F.sum("n")).collect():
        census[i] = n
    ordinary = Ordinary(census)

    @F.pandas_udf("array<struct<start:int,end:int,class:int,step:int,random:double>>")
    def judged(tested: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in tested:
            yield pd.Series([
                [
                    (int(a), int(b), length_class(int(b - a)), ordinary.step(int(b - a), int(k), pairs, changes), p)
                    for a, b, k, pairs, changes, p in rows
                ]
                for rows in batch
            ])

    tested = found.where(F.size("tested") > 0).select(F.explode(judged("tested")).alias("t"))
    counts = {(k, s): n for k, s, n in tested.groupBy("t.class", "t.step").count().collect()}
    cuts = _cuts(counts, false_share)
    least = F.create_map(*[F.lit(v) for pair in (cuts or {-1: 0}).items() for v in pair])
    good = F.filter(
        judged("tested"), lambda t: (t["random"] >= LEAST_RANDOM) & (t["step"] >= F.coalesce(least[t["class"]], F.lit(STEPS + 1)))
    )
    return unpack(_with_spans(found.withColumn("good", good)), "n_assign", "n_access", "n_hex", "n_random", "base", "spans")


def _with_spans(found: DataFrame) -> DataFrame:
    """``spans`` from the text form of the fixed patterns and the accepted candidates."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    old = F.transform(
        F.filter(F.split("base", ","), lambda s: s != ""),
        lambda s: F.struct(
            F.split(s, ":")[1].cast("int").alias("start"),
            (F.array_position(kinds, F.split(s, ":")[0]) - 1).cast("int").alias("kind"),
            F.split(s, ":")[2].cast("int").alias("end"),
        ),
    )
    new = F.transform("good", lambda t: F.struct(t["start"].alias("start"), F.lit(3).alias("kind"), t["end"].alias("end")))
    spans = F.transform(
        F.array_sort(F.concat(old, new)), lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"], s["end"])
    )
    return found.withColumn("spans", F.array_join(spans, ",")).withColumn("n_random", F.size("good").cast("long"))


def _blanked(texts: pd.Series, spans: pd.Series) -> pd.Series:
    out = []
    for text, listed in zip(texts, spans, strict=True):
        if text and listed:
            parts, at = [], 0
            for a, b in sorted(tuple(map(int, s.split(":")[1:])) for s in listed.split(",")):
                if a >= at:
                    parts += [text[at:a], "[SECRET]"]
                at = max(at, b)
            text = "".join(parts) + text[at:]
        out.append(text)
    return pd.Series(out, dtype=object)


def redact(text: Column, spans: Column) -> Column:
    """The text with every span (overlapping ones together) replaced by ``[SECRET]``."""
    return F.when(spans == "", text).otherwise(F.pandas_udf(_blanked, "string")(text, spans))
