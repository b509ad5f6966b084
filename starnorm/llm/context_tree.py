"""Context-tree weighting over bytes, each taken apart into eight binary decisions.

A decision is a node of the byte's binary tree, ``(1 << j) | (the byte's j first
bits)``. Each decision has a context tree over the bytes before it, nearest first. A
tree node holds how often 0 and 1 came; its estimate is Krichevsky and Trofimov's, and
its weighted probability mixes that estimate with the product of its children's, half
and half, down to the deepest context. From the counts follows the weight with which a
node stops, so a byte's probability is a mixture over the estimates of all depths.

Grams are numbers: the nearest context byte highest, the predicted byte lowest.
"""

from __future__ import annotations

import numpy as np

from starnorm.llm.spans import group_starts

DEPTH = 5
_HALF = np.log(0.5)
_TABLE = 1 << 16
_half_logs = np.concatenate([[0.0], np.cumsum(np.log(np.arange(_TABLE) + 0.5))])
_logs = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, _TABLE + 1)))])


def _stirling(x: np.ndarray) -> np.ndarray:
    """log Gamma for large x."""
    return (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + 1 / (12 * x) - 1 / (360 * x**3)


def _half_factorial(n: np.ndarray) -> np.ndarray:
    """log of (1/2)(3/2)...(n - 1/2)."""
    large = _stirling(np.maximum(n, _TABLE) + 0.5) - 0.5 * np.log(np.pi)
    return np.where(n <= _TABLE, _half_logs[np.minimum(n, _TABLE)], large)


def _factorial(n: np.ndarray) -> np.ndarray:
    large = _stirling(np.maximum(n, _TABLE) + 1.0)
    return np.where(n <= _TABLE, _logs[np.minimum(n, _TABLE)], large)


def log_estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Natural log of the Krichevsky-Trofimov probability of a sequence with such counts."""
    return _half_factorial(zeros) + _half_factorial(ones) - _factorial(zeros + ones)


def weighted(zeros: np.ndarray, ones: np.ndarray, below: np.ndarray):
    """log weighted probability of nodes, and the weight with which each stops.

    ``below`` is the sum of the children's log weighted probabilities.
    """
    stop = _HALF + log_estimate(zeros, ones)
    total = np.logaddexp(stop, _HALF + below)
    return total, np.exp(stop - total)


class Level:
    """The nodes of one depth and one bit, sorted by (context, decision)."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, bit: int):
        x = grams & np.uint64(255)
        decision = np.uint64(1 << bit) | (x >> np.uint64(8 - bit))
        keys = (grams >> np.uint64(8) << np.uint64(8)) | decision
        first = group_starts(keys)
        one = (x >> np.uint64(7 - bit)) & np.uint64(1)
        self.keys = keys[first]
        self.ones = np.add.reduceat(counts * one.astype(np.int64), first)
        self.zeros = np.add.reduceat(counts, first) - self.ones

    def finish(self, deeper: Level | None) -> None:
        """Weigh the nodes against those one byte deeper; the deepest always stop."""
        if deeper is None:
            self.weighted = log_estimate(self.zeros, self.ones)
            self.stop = np.ones(self.keys.size)
            return
        parent = (deeper.keys >> np.uint64(16) << np.uint64(8)) | (deeper.keys & np.uint64(255))
        at = np.searchsorted(self.keys, parent)
        below = np.bincount(at, deeper.weighted, minlength=self.keys.size)
        self.weighted, self.stop = weighted(self.zeros, self.ones, below)

    def mix(self, keys: np.ndarray, one: np.ndarray, deeper: np.ndarray) -> np.ndarray:
        """Probability of each decision's outcome, given the one from deeper contexts."""
        if not self.keys.size:
            return deeper
        at = np.minimum(np.searchsorted(self.keys, keys), self.keys.size - 1)
        known = self.keys[at] == keys
        zeros, ones, stop = self.zeros[at], self.ones[at], self.stop[at]
        return np.where(known, mixture(zeros, ones, stop, one, deeper), deeper)


def mixture(zeros, ones, stop, one, deeper) -> np.ndarray:
    estimate = (np.where(one, ones, zeros) + 0.5) / (zeros + ones + 1)
    return stop * estimate + (1 - stop) * deeper


class Forest:
    """All nodes of depth ``top`` and more, from distinct sorted grams and their counts."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, depth: int = DEPTH, top: int = 2):
        self.depth, self.top = depth, top
        self.levels: dict[tuple[int, int], Level] = {}
        for d in range(depth, top - 1, -1):
            for bit in range(8):
                level = self.levels[d, bit] = Level(grams, counts, bit)
                level.finish(self.levels.get((d + 1, bit)))
            shorter = (grams >> np.uint64(16) << np.uint64(8)) | (grams & np.uint64(255))
            order = np.argsort(shorter, kind="stable")
            first = group_starts(shorter[order])
            grams = shorter[order][first]
            counts = np.add.reduceat(counts[order], first) if first.size else counts[:0]

    def sums(self):
        """Per (context one byte shorter, decision): zeros, ones, log weighted sum."""
        for bit in range(8):
            level = self.levels[self.top, bit]
            parent = (level.keys >> np.uint64(16) << np.uint64(8)) | (level.keys & np.uint64(255))
            order = np.argsort(parent, kind="stable")
            first = group_starts(parent[order])
            if first.size:
                yield (
                    parent[order][first],
                    np.add.reduceat(level.zeros[order], first),
                    np.add.reduceat(level.ones[order], first),
                    np.add.reduceat(level.weighted[order], first),
                )

    def log10(self, grams: np.ndarray, upper) -> np.ndarray:
        """log10 of the probability of each gram's byte after its context.

        ``upper(bit, decision, one, p)`` mixes in the depths above ``top``.
        """
        x = grams & np.uint64(255)
        out = np.zeros(grams.size)
        for bit in range(8):
            decision = np.uint64(1 << bit) | (x >> np.uint64(8 - bit))
            one = ((x >> np.uint64(7 - bit)) & np.uint64(1)).astype(bool)
            p = np.full(grams.size, 0.5)
            for d in range(self.depth, self.top - 1, -1):
                context = grams >> np.uint64(8 * (self.depth - d + 1)) << np.uint64(8)
                p = self.levels[d, bit].mix(context | decision, one, p)
            out += np.log10(upper(decision.astype(np.int64), one, p))
        return out
