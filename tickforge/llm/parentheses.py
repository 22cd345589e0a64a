"""A balanced-parentheses sequence with range min-max search and rank of leaf pairs."""

import numpy as np

#: Positions that share one minimum and maximum of the excess.
BLOCK = 64


class Parentheses:
    """``bits`` holds 1 for an opening and 0 for a closing parenthesis; all are matched."""

    def __init__(self, bits: np.ndarray):
        self.bits = np.asarray(bits, np.int8)
        n = len(self.bits)
        self.excess = np.cumsum(2 * self.bits.astype(np.int64) - 1)
        padded = np.full(-(-n // BLOCK) * BLOCK, np.iinfo(np.int64).max)
        padded[:n] = self.excess
        lows = padded.reshape(-1, BLOCK).min(axis=1)
        padded[n:] = np.iinfo(np.int64).min
        highs = padded.reshape(-1, BLOCK).max(axis=1)
        # Trees over the blocks, leaves at the end: node i covers nodes 2i and 2i + 1.
        self.leaves = 1 << max(0, len(lows) - 1).bit_length()
        self.low = np.full(2 * self.leaves, np.iinfo(np.int64).max)
        self.high = np.full(2 * self.leaves, np.iinfo(np.int64).min)
        self.low[self.leaves : self.leaves + len(lows)] = lows
        self.high[self.leaves : self.leaves + len(highs)] = highs
        for i in range(self.leaves - 1, 0, -1):
            self.low[i] = min(self.low[2 * i], self.low[2 * i + 1])
            self.high[i] = max(self.high[2 * i], self.high[2 * i + 1])
        pairs = (self.bits[:-1] == 1) & (self.bits[1:] == 0)
        self.pairs = np.concatenate([[0], np.cumsum(pairs), [pairs.sum()]])

    def _scan(self, start: np.ndarray, target: np.ndarray) -> np.ndarray:
        """First position from ``start`` to the end of its block with that excess, or -1."""
        found, n = np.full(len(start), -1), len(self.bits)
        last = np.minimum((start // BLOCK + 1) * BLOCK, n)
        for step in range(BLOCK):
            at = start + step
            open_ = np.flatnonzero((found < 0) & (at < last))
            if not len(open_):
                break
            hit = open_[self.excess[at[open_]] == target[open_]]
            found[hit] = at[hit]
        return found

    def findclose(self, opens: np.ndarray) -> np.ndarray:
        """Position of the parenthesis that closes each of ``opens``: the first one behind it
        whose excess is one less than its own."""
        opens = np.asarray(opens, np.int64)
        target = self.excess[opens] - 1
        found = self._scan(opens + 1, target)
        # At the last place of a block the scan has begun in the next one.
        rest = np.flatnonzero(found < 0)
        node = self.leaves + (opens[rest] + 1) // BLOCK
        holds = lambda at: (self.low[at] <= target[rest]) & (target[rest] <= self.high[at])
        # Up to the first subtree further right that holds the excess, then down to its block.
        up = np.ones(len(rest), bool)
        while up.any():
            right = (node % 2 == 0) & holds(np.minimum(node + 1, 2 * self.leaves - 1))
            node = np.where(up, np.where(right, node + 1, node // 2), node)
            up &= ~right
        while (inner := node < self.leaves).any():
            left = np.where(inner, 2 * node, node)
            node = np.where(inner, np.where(holds(left), left, left + 1), node)
        found[rest] = self._scan((node - self.leaves) * BLOCK, target[rest])
        return found

    def leaf_pairs(self, opens: np.ndarray, closes: np.ndarray) -> np.ndarray:
        """Pairs "()" from each opening parenthesis to its closing one: leaves below it."""
        return self.pairs[closes] - self.pairs[opens]
