"""Double-array tries that many positions walk at once: plain arrays, no Spark.

A trie is two arrays: the children of state s stand at `base[s]` plus their
digit, and `check` there names s. Children of all states share the arrays in
each other's gaps.
"""

from __future__ import annotations

import numpy as np

DIGIT_BITS = 8  # symbols are walked in digits, so that no state has many children
RADIX = 1 << DIGIT_BITS
SEED = 5
CROWDED = 8  # the arrays grow where less than one state in so many finds a place


def digits(symbols: np.ndarray, count: int) -> np.ndarray:
    """Columns of digits of whole numbers, the highest first."""
    shifts = DIGIT_BITS * np.arange(count - 1, -1, -1)
    return symbols[..., None] >> shifts & (RADIX - 1)


def digits_for(symbols: int) -> int:
    """Digits that tell so many symbols apart."""
    return max(1, -(-max(symbols - 1, 1).bit_length() // DIGIT_BITS))


class Trie:
    """Phrases of one length over numbered symbols; each state at full depth accepts one.

    `phrases` has a row of symbols per phrase, all different; symbols are below
    `symbols`. `accepts` gives the row, -1 for states inside.
    """

    def __init__(self, phrases: np.ndarray, symbols: int):
        self.symbols, self.digits = symbols, digits_for(symbols)
        paths = digits(phrases.astype(np.int64), self.digits).reshape(
            len(phrases), phrases.shape[1] * self.digits)
        node, nodes = np.zeros(len(paths), np.int64), 1
        parents, steps = [], []
        for column in paths.T:
            codes, inverse = np.unique(node * RADIX + column, return_inverse=True)
            parents.append(codes >> DIGIT_BITS)
            steps.append(codes & (RADIX - 1))
            node = nodes + inverse
            nodes += len(codes)
        parent, step = np.concatenate([np.zeros(0, np.int64), *parents]), np.concatenate(
            [np.zeros(0, np.int64), *steps])
        base_of, size = self._places(parent, step, nodes)
        slot = np.concatenate([[size], base_of[parent] + step])  # of each node; the root stands last
        self.root = size
        self.base = np.zeros(size + 1, np.int32)
        self.base[slot] = base_of
        self.check = np.full(size + RADIX, -1, np.int32)
        self.check[slot[1:]] = slot[parent]
        self.accepts = np.full(size + 1, -1, np.int32)
        self.accepts[slot[node]] = np.arange(len(phrases))
        self.begun = np.full(symbols, -1, np.int32)  # the state that a first symbol leads to
        at, state = self._stepped(
            np.arange(symbols), np.full(symbols, self.root, np.int32), np.arange(symbols))
        self.begun[at] = state

    @staticmethod
    def _places(parent: np.ndarray, step: np.ndarray, nodes: int) -> tuple[np.ndarray, int]:
        """Where the children of each node begin, and the slots needed; most children first."""
        pick = np.random.default_rng(SEED)
        count = np.bincount(parent, minlength=nodes)
        starts = np.cumsum(count) - count
        base = np.zeros(nodes, np.int64)
        low, used = 0, np.zeros(2 * len(parent) + RADIX, bool)
        for size in np.unique(count[count > 0])[::-1]:
            rest = np.flatnonzero(count == size)
            of = step[starts[rest][:, None] + np.arange(size)]
            while len(rest):
                place = pick.integers(low, len(used) - RADIX + 1, len(rest))
                slots = place[:, None] + of
                free = np.flatnonzero(~used[slots].any(axis=1))
                own = np.zeros(slots[free].size, bool)
                own[np.unique(slots[free], return_index=True)[1]] = True
                taken = free[own.reshape(-1, size).all(axis=1)]
                used[slots[taken]] = True
                base[rest[taken]] = place[taken]
                if len(taken) * CROWDED < len(rest):
                    low = len(used) - RADIX + 1
                    used = np.concatenate([used, np.zeros(2 * len(rest) * size + RADIX, bool)])
                left = np.ones(len(rest), bool)
                left[taken] = False
                rest, of = rest[left], of[left]
        return base, len(used)

    def _stepped(
        self, at: np.ndarray, state: np.ndarray, symbol: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """The positions whose state has a child by their symbol, and that child."""
        for place in range(self.digits - 1, -1, -1):
            child = self.base[state] + (symbol >> DIGIT_BITS * place & (RADIX - 1))
            alive = self.check[child] == state
            at, state, symbol = at[alive], child[alive], symbol[alive]
        return at, state

    def accepted(self, symbols: np.ndarray, depth: int, heads: np.ndarray) -> np.ndarray:
        """Per position the phrase that its head and the `depth` symbols from it on spell, or -1.

        A negative symbol ends every phrase. All positions go on together, a
        digit at a time; those whose state has no such child drop out.
        """
        at = np.flatnonzero((symbols[:max(0, len(symbols) - depth + 1)] >= 0) & (
            heads[:max(0, len(symbols) - depth + 1)] >= 0))
        state = self.begun[heads[at]]
        at, state = at[state >= 0], state[state >= 0]
        for level in range(depth):
            symbol = symbols[at + level]
            alive = symbol >= 0
            at, state = self._stepped(at[alive], state[alive], symbol[alive])
        out = np.full(len(symbols), -1, np.int64)
        out[at] = self.accepts[state]
        return out
