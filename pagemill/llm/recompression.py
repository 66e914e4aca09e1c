"""A run-length grammar by recompression, and longest common extensions on it.

Level 0 is the sequence itself. A level of blocks replaces each maximal run of one symbol by a symbol for
(symbol, count); a level of pairs splits the symbols into left and right ones and replaces each left symbol
followed by a right one by a symbol for the pair. Levels alternate until one symbol is left. Equal
stretches get equal symbols everywhere but near their ends, so two positions are compared by climbing to the
highest nodes that both begin and that agree, and descending where they differ.
"""

from __future__ import annotations

import numpy as np

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _side(symbols: np.ndarray, seed: int) -> np.ndarray:
    """A pseudo-random bit of each symbol."""
    with np.errstate(over="ignore"):
        x = (symbols.astype(np.uint64) + np.uint64(seed)) * _GOLDEN
        x ^= x >> np.uint64(29)
        x *= _GOLDEN
    return (x >> np.uint64(47)) & np.uint64(1) == 1


def _pair_starts(symbols: np.ndarray, seed: int) -> np.ndarray:
    """Places of pairs to replace: the better of left-right and right-left; adjacent symbols differ."""
    while True:
        left = _side(symbols, seed)
        ahead = np.flatnonzero(left[:-1] & ~left[1:])
        back = np.flatnonzero(~left[:-1] & left[1:])
        best = ahead if len(ahead) >= len(back) else back
        if len(best):
            return best
        seed += 1 << 20


class Grammar:
    """Of a non-empty sequence of small whole numbers."""

    def __init__(self, sequence: np.ndarray):
        symbols = np.asarray(sequence, dtype=np.int64)
        size = np.ones(len(symbols), dtype=np.int64)
        #: Of each level: symbols, words below each node, first child of each node (and the end), whether blocks.
        self._levels = [(symbols.tolist(), size.tolist(), None, False)]
        #: Of each level but the top: each node's parent.
        self._parents: list[list[int]] = []
        seed = 1
        while len(symbols) > 1:
            change = np.flatnonzero(symbols[1:] != symbols[:-1]) + 1
            if len(change) + 1 < len(symbols):
                first = np.concatenate([[0], change])
                count = np.diff(np.append(first, len(symbols)))
                symbols, size = self._climb(symbols, size, first, count, True)
                if len(symbols) == 1:
                    break
            second = _pair_starts(symbols, seed) + 1
            begins = np.ones(len(symbols), dtype=bool)
            begins[second] = False
            first = np.flatnonzero(begins)
            partner = np.zeros(len(symbols), dtype=np.int64)
            partner[second - 1] = symbols[second] + 1
            symbols, size = self._climb(symbols, size, first, partner[first], False)
            seed += 1

    def _climb(self, symbols, size, first, mark, blocks):
        """Add the level whose nodes begin at ``first`` and are told by their first symbol and ``mark``."""
        told = symbols[first] * (int(mark.max()) + 1) + mark
        named = np.unique(told, return_inverse=True)[1].astype(np.int64)
        sizes = np.add.reduceat(size, first)
        parent = np.zeros(len(symbols), dtype=np.int64)
        parent[first[1:]] = 1
        self._parents.append(np.cumsum(parent).tolist())
        self._levels.append((named.tolist(), sizes.tolist(), [*first.tolist(), len(symbols)], blocks))
        return named, sizes

    def extend(self, a: int, b: int) -> int:
        """How many symbols from ``a`` on equal those from ``b`` on, a < b."""
        level, x, y, total = 0, a, b, 0
        top = len(self._levels) - 1
        while True:
            symbols, size, first, _ = self._levels[level]
            if y >= len(symbols):
                return total
            step = 1
            if level < top:
                p, q = self._parents[level][x], self._parents[level][y]
                above, _, start, blocks = self._levels[level + 1]
                if start[p] == x and start[q] == y and above[p] == above[q]:
                    level, x, y = level + 1, p, q
                    continue
                if blocks:
                    step = min(start[p + 1] - x, start[q + 1] - y)
            if symbols[x] == symbols[y]:
                total += step * size[x]
                x, y = x + step, y + step
            elif level:
                level, x, y = level - 1, first[x], first[y]
            else:
                return total

    def extend_back(self, a: int, b: int) -> int:
        """How many symbols before ``a`` equal those before ``b``, a < b."""
        level, x, y, total = 0, a - 1, b - 1, 0
        top = len(self._levels) - 1
        while True:
            if x < 0:
                return total
            symbols, size, first, _ = self._levels[level]
            step = 1
            if level < top:
                p, q = self._parents[level][x], self._parents[level][y]
                above, _, start, blocks = self._levels[level + 1]
                if start[p + 1] - 1 == x and start[q + 1] - 1 == y and above[p] == above[q]:
                    level, x, y = level + 1, p, q
                    continue
                if blocks:
                    step = min(x - start[p], y - start[q]) + 1
            if symbols[x] == symbols[y]:
                total += step * size[x]
                x, y = x - step, y - step
            elif level:
                level, x, y = level - 1, first[x + 1] - 1, first[y + 1] - 1
            else:
                return total
