"""Double-array tries over sequences of numbers, walked for many positions at once.

A number is read in digits of eight bits, as many for all numbers as the largest needs, so a state has
at most 256 successors. The successor of state ``s`` by digit ``d`` is ``t = base[s] + d`` if ``check[t] == s``; there is
no other structure, and a step for a million positions is two array look-ups.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_FULL = 48  # states with so many successors get 256 places of their own


@dataclass(frozen=True)
class Trie:
    base: np.ndarray
    check: np.ndarray
    #: The row of the sequence that ends in a state, or -1.
    row: np.ndarray
    digits: int

    def step(self, states: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """The states after one more number each (of ``digits`` digits); -1 where there is none, or was none before."""
        for d in reversed(range(self.digits)):
            places = self.base[states] + ((numbers >> (8 * d)) & 255)
            states = np.where((states >= 0) & (self.check[places] == states), places, -1)
        return states

    def ends(self, numbers: np.ndarray, length: int) -> np.ndarray:
        """For every position the row of the sequence of ``length`` numbers that starts there, or -1.

        Level by level: all positions take their first number, those with a state left their second, and so on. Numbers
        are at least 0; 0 is in no sequence, so none goes past one. The last positions are too near to the end.
        """
        out = np.full(len(numbers), -1, np.int64)
        numbers = np.where(numbers < 1 << 8 * self.digits, numbers, 0)
        at = np.flatnonzero(numbers[: max(len(numbers) - length + 1, 0)])
        states = np.zeros(len(at), np.int64)
        for level in range(length):
            states = self.step(states, numbers[at + level])
            alive = states >= 0
            at, states = at[alive], states[alive]
        out[at] = self.row[states]
        return out


def build(sequences: np.ndarray) -> Trie:
    """The trie of distinct sequences (rows of positive numbers, all of one length)."""
    count, length = sequences.shape
    largest = int(sequences.max(initial=1))
    digits = max(1, -(-largest.bit_length() // 8))
    order = np.lexsort(sequences.T[::-1]) if count else np.zeros(0, np.int64)
    shifts = 8 * np.arange(digits - 1, -1, -1)
    symbols = ((sequences[order][:, :, None] >> shifts) & 255).reshape(count, length * digits)

    # Nodes by depth: a new one wherever a sorted row differs from the one before in its first symbols.
    differs = np.ones(count, bool)
    new = np.zeros((length * digits, count), bool)
    differs[1:] = False
    for depth in range(length * digits):
        differs[1:] |= symbols[1:, depth] != symbols[:-1, depth]
        new[depth] = differs
    sizes = new.sum(1)
    first = np.cumsum(sizes) - sizes + 1  # number of the first node of each depth; 0 is the root
    parent, symbol = np.zeros(int(sizes.sum()), np.int64), np.zeros(int(sizes.sum()), np.int64)
    above = np.zeros(count, np.int64)
    for depth in range(length * digits):
        node = first[depth] + np.cumsum(new[depth]) - 1
        at = new[depth]
        parent[node[at] - 1], symbol[node[at] - 1] = above[at], symbols[at, depth]
        above = node
    base, place, size = _placed(parent, symbol)
    check = np.full(size, -2, np.int64)
    check[place[1:]] = place[parent]
    bases, row = np.zeros(size, np.int64), np.full(size, -1, np.int64)
    bases[place] = base
    if count:
        row[place[above]] = order
    return Trie(bases, check, row, digits)


def _placed(parent: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Bases and places of all nodes (the root is node 0 at place 0), such that no two nodes share a place.

    Nodes come with parents in ascending order. Those with many successors get rows of 256 places; the others try random
    bases, all of them at once and those with more successors first, until none of their places is taken.
    """
    nodes = len(parent) + 1
    fan = np.bincount(parent, minlength=nodes)
    start = np.cumsum(fan) - fan
    base, place = np.zeros(nodes, np.int64), np.zeros(nodes, np.int64)
    full = np.flatnonzero(fan >= _FULL)
    base[full] = 1 + 256 * np.arange(len(full))
    size = 1 + 256 * len(full) + 2 * int(fan[fan < _FULL].sum()) + 512
    taken = np.zeros(size, bool)
    taken[0] = True
    rng = np.random.default_rng(0)

    def successors(of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of each successor of the nodes, and which of the nodes it belongs to."""
        owner = np.repeat(np.arange(len(of)), fan[of])
        return np.arange(len(owner)) - (np.cumsum(fan[of]) - fan[of])[owner] + start[of][owner], owner

    child, owner = successors(full)
    place[child + 1] = base[full][owner] + symbol[child]
    taken[place[child + 1]] = True
    for least, most in ((24, _FULL), (12, 24), (6, 12), (3, 6), (2, 3)):
        left, tries = np.flatnonzero((fan >= least) & (fan < most)), 0
        while len(left):
            tries += 1
            if tries % 16 == 0:  # too crowded for this many successors
                taken = np.append(taken, np.zeros(max(512, len(taken) // 4), bool))
            at = rng.integers(1, len(taken) - 256, len(left))
            child, owner = successors(left)
            wanted = at[owner] + symbol[child]
            # Of the nodes that want one place the first has it; who loses one place tries again as a whole.
            _, earliest = np.unique(wanted, return_index=True)
            lost = np.ones(len(wanted), bool)
            lost[earliest] = False
            lost |= taken[wanted]
            fails = np.bincount(owner, weights=lost, minlength=len(left)) > 0
            good = ~fails[owner]
            place[child[good] + 1] = wanted[good]
            taken[wanted[good]] = True
            base[left[~fails]] = at[~fails]
            left = left[fails]
    single = np.flatnonzero(fan == 1)
    child = start[single]
    free = np.flatnonzero(~taken[256:]) + 256  # so that no base is negative
    if len(free) < len(single):
        taken = np.append(taken, np.zeros(len(single) - len(free), bool))
        free = np.flatnonzero(~taken[256:]) + 256
    place[child + 1] = free[: len(single)]
    base[single] = place[child + 1] - symbol[child]
    size = int(max(place.max(initial=0), base.max(initial=0))) + 257
    return base, place, size
