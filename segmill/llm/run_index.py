"""Run-length index over short byte strings: BWT runs, suffix-array samples at run ends, matching statistics.

Where neighbouring rows of the Burrows-Wheeler transform hold the same symbol, the common
prefix of their suffixes is one longer than that of the suffixes one symbol before. So only at
run ends are suffix positions sampled and common prefixes measured; all other matching
statistics follow from the last sample by counting down. In repetitive texts runs are few.
"""

from __future__ import annotations

import numpy as np

_BITS, _FIRST = 9, 7  # a symbol (separator or byte) takes 9 bits, and 7 of them fit one number


def suffix_ranks(symbols: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix array, and per doubling step the ranks by the first 7 * 2**step symbols.

    ``room[i]`` symbols are left in the string of position i; suffixes whose separator lies
    within the compared length rank apart, in order of position, so no comparison crosses a
    separator and the order stays that of the symbols before.
    """
    n = len(symbols)
    padded = np.concatenate([symbols, np.zeros(_FIRST, symbols.dtype)]).astype(np.int64)
    key = np.zeros(n, np.int64)
    for i in range(_FIRST):
        key = (key << _BITS) | np.where(room >= i, padded[i : i + n], 0)
    levels, length = [], _FIRST
    order = np.argsort(key)
    ended = np.flatnonzero((room < _FIRST)[order])
    order[ended] = order[ended][np.lexsort((order[ended], key[order[ended]]))]
    ranks = _ranked(order, key, room, length)
    levels.append(ranks)
    while True:
        places = np.flatnonzero(_in_tie(ranks[order]))
        if not len(places):
            return order, levels
        tied = order[places]
        both = ranks[tied] * n + ranks[tied + length]  # within the string or its separator, as the tie is not broken
        resort = np.argsort(both)
        tied, both = tied[resort], both[resort]
        order[places] = tied
        fresh = np.ones(len(both), bool)
        fresh[1:] = both[1:] != both[:-1]
        ranks = ranks.copy()
        ranks[tied] = np.maximum.accumulate(np.where(fresh, places, 0))
        length *= 2
        levels.append(ranks)


def _ranked(order: np.ndarray, key: np.ndarray, room: np.ndarray, length: int) -> np.ndarray:
    sorted_key, ended = key[order], room[order] < length
    fresh = np.ones(len(order), bool)
    fresh[1:] = (sorted_key[1:] != sorted_key[:-1]) | ended[1:] | ended[:-1]
    ranks = np.empty(len(order), np.int64)
    ranks[order] = np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))
    return ranks


def _in_tie(ranks: np.ndarray) -> np.ndarray:
    """Of ranks in order: which ones a neighbour shares."""
    same = ranks[1:] == ranks[:-1]
    out = np.zeros(len(ranks), bool)
    out[1:] |= same
    out[:-1] |= same
    return out


def _common(a: np.ndarray, b: np.ndarray, symbols: np.ndarray, room: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Length of the common prefix of the suffixes at ``a`` and ``b`` within their strings."""
    most = np.minimum(room[a], room[b])
    done = np.zeros(len(a), np.int64)
    n = len(symbols)
    for step in range(len(levels) - 1, -1, -1):
        length = _FIRST << step
        x, y = np.minimum(a + done, n - 1), np.minimum(b + done, n - 1)
        done += length * ((done + length < most) & (levels[step][x] == levels[step][y]))
    open_ = done < most
    while open_.any():  # fewer than 2 * 7 symbols are left, or the string's last ones
        i = np.flatnonzero(open_)
        same = symbols[a[i] + done[i]] == symbols[b[i] + done[i]]
        done[i] += same
        open_[i] = same & (done[i] < most[i])
    return done


def matching_statistics(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For every position of the joined strings (a separator after each), the longest match of what
    follows, within its string, at any other position; and the first position of each string."""
    lengths = np.array([len(s) for s in strings], np.int64)
    firsts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]]).astype(np.int64)
    symbols = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8).astype(np.int16) + 1
    ends = firsts + lengths
    symbols[ends] = 0
    n = len(symbols)
    room = np.repeat(ends, lengths + 1) - np.arange(n)
    order, levels = suffix_ranks(symbols, room)
    before = symbols[order - 1]  # the transform; position 0 is preceded by the last separator
    change = before[1:] != before[:-1]
    stop = before == 0  # runs of separators are cut: what precedes belongs to other strings
    change |= stop[1:] | stop[:-1]
    at = np.flatnonzero(change)
    sampled = _common(order[at], order[at + 1], symbols, room, levels)
    best = np.zeros(n, np.int64)
    for places, ends_first in ((order[at + 1], order[0]), (order[at], order[-1])):
        value = np.zeros(n, np.int64)
        known = np.zeros(n, bool)
        value[places] = sampled
        known[places] = True
        known[ends_first] = True  # no neighbour on this side
        known[firsts] = True
        last = np.maximum.accumulate(np.where(known, np.arange(n), 0))
        best = np.maximum(best, value[last] - (np.arange(n) - last))
    return np.minimum(best, room), firsts
