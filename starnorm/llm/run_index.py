"""A run-compressed Burrows-Wheeler transform of a collection of strings.

Suffixes are sorted by doubling, each ending at its string's end; equal ones go by
string number, so the order is that of the collection with distinct end marks. The
transform is cut into runs; what is kept of it is the text position at both ends of
every run.

Inside a run, neighbouring suffixes stay neighbours one byte to the left and their
match grows by one, so a match can only begin where two runs meet. The length of the
match at those places, one sample for each run end, gives the matching statistics of
every other position: they fall by one per byte from the sample before it.
"""

from __future__ import annotations

import numpy as np

from starnorm.llm.blocks import pow2

_SYMBOL_BITS = 9


class RunIndex:
    """Index of strings laid end to end in ``text``, one mark after each.

    ``ends`` are the places of the marks; what byte stands there is of no matter.
    """

    def __init__(self, text: np.ndarray, ends: np.ndarray):
        self.size = text.size
        self.end = np.repeat(ends, np.diff(np.append(-1, ends)))
        self.symbols = text.astype(np.uint64) + np.uint64(1)
        self.symbols[ends] = 0
        order = self._sort(int(np.diff(np.append(-1, ends)).max()))
        before = np.where(order > 0, self.symbols[order - 1], 0)
        # A string's start has no byte before it: such suffixes are runs of their own.
        new = np.ones(order.size, bool)
        new[1:] = (before[1:] != before[:-1]) | (before[1:] == 0)
        first = np.flatnonzero(new)
        last = np.append(first[1:], order.size) - 1
        self.first_sample, self.last_sample = order[first], order[last]

    def _sort(self, longest: int) -> np.ndarray:
        bits = max(1, pow2(self.size + 1))
        place = np.arange(self.size, dtype=np.uint64)
        at = np.arange(self.size)
        step = next(k for k in (5, 4, 2, 1) if k * _SYMBOL_BITS + bits <= 64)
        key = np.zeros(self.size, np.uint64)
        for j in range(step):
            key <<= np.uint64(_SYMBOL_BITS)
            key |= self.symbols[np.minimum(at + j, self.end)]
        self.levels: list[tuple[int, np.ndarray]] = []
        shift, mask = np.uint64(bits), np.uint64((1 << bits) - 1)
        packed = True
        fan = 64 // bits - 1
        if fan < 2:
            fan, packed = 2, False  # the place does not fit beside two ranks
        while True:
            if packed or not self.levels:
                key = np.sort(key << shift | place)
                order = (key & mask).astype(np.int64)
                key >>= shift
            else:
                order = np.argsort(key, kind="stable")
                key = key[order]
            ranks = np.zeros(self.size, np.uint64)
            ranks[order[1:]] = np.cumsum(key[1:] != key[:-1])
            self.levels.append((step, ranks))
            if step >= longest:
                return order
            key = ranks.copy()
            for j in range(1, fan):
                key <<= shift
                key |= ranks[np.minimum(at + j * step, self.end)]
            step *= fan

    def _matched(self, p: np.ndarray, q: np.ndarray, length: int) -> np.ndarray:
        """Whether the suffixes at p and q agree on ``length`` bytes, both being that long."""
        same, done = np.ones(p.size, bool), 0
        for step, ranks in reversed(self.levels):
            while done + step <= length:
                same &= ranks[p + done] == ranks[q + done]
                done += step
        for k in range(done, length):
            same &= self.symbols[p + k] == self.symbols[q + k]
        return same

    def _extended(self, p: np.ndarray, q: np.ndarray, length: int) -> np.ndarray:
        """Length of the common prefix, known to be ``length`` at least."""
        most = np.minimum(self.end[p] - p, self.end[q] - q)
        common = np.full(p.size, length)
        for step, ranks in [*reversed(self.levels), (1, self.symbols)]:
            going = np.flatnonzero(common < most)
            while going.size:
                a, b = p[going] + common[going], q[going] + common[going]
                going = going[ranks[a] == ranks[b]]
                common[going] = np.minimum(common[going] + step, most[going])
                going = going[common[going] < most[going]]
        return common

    def long_matches(self, length: int) -> np.ndarray:
        """For each place of the text, whether a match of ``length`` bytes covers it."""
        p, q = self.last_sample[:-1], self.first_sample[1:]
        keep = (self.end[p] - p >= length) & (self.end[q] - q >= length)
        p, q = p[keep], q[keep]
        same = self._matched(p, q, length)
        p, q = p[same], q[same]
        common = self._extended(p, q, length)
        reach = np.zeros(self.size, np.int64)
        np.maximum.at(reach, p, p + common)
        np.maximum.at(reach, q, q + common)
        # What is left of the last sampled match when it has streamed to this place.
        statistics = np.maximum.accumulate(reach) - np.arange(self.size)
        return statistics > 0
