"""Suffix arrays over rows of numbered words, and binary search in them."""

from __future__ import annotations

import numpy as np

from starnorm.llm.spans import ranges


class SuffixArray:
    """The suffixes of ``words`` in order, as far as ``depth`` words tell them apart.

    Words are numbered from 1 on; 0 stands between rows, below all words, and matches
    nothing. A suffix counts up to the next 0; equal ones are in some fixed order.
    """

    def __init__(self, words: np.ndarray, depth: int):
        # Places past the end read as 0.
        self.words = np.append(words, 0).astype(np.int64)
        self.places = np.argsort(words, kind="stable")
        if not words.size:
            return
        rank = np.append(_ranks(words[self.places], self.places), 0)
        known = 1
        while known < depth:
            # Only suffixes that share their rank are told apart any further.
            ordered = rank[self.places]
            shared = np.zeros(ordered.size, bool)
            same = ordered[1:] == ordered[:-1]
            shared[1:] = same
            shared[:-1] |= same
            shared &= self.words[self.places] > 0
            slots = np.flatnonzero(shared)
            if not slots.size:
                break
            at = self.places[slots]
            own, after = ordered[slots], rank[np.minimum(at + known, words.size)]
            order = np.lexsort((after, own))
            own, after = own[order], after[order]
            new = np.ones(slots.size, bool)
            new[1:] = own[1:] != own[:-1]
            split = new.copy()
            split[1:] |= after[1:] != after[:-1]
            self.places[slots] = at[order]
            # A rank is the slot of the first suffix that has it, counted from 1.
            first = np.maximum.accumulate(np.where(split, np.arange(slots.size), 0))
            rank[at[order]] = slots[first] + 1
            known *= 2

    def narrowed(
        self, lo: np.ndarray, hi: np.ndarray, depth: int, wanted: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Of the suffixes in ``[lo, hi)``, alike so far, those with ``wanted`` at ``depth``."""
        return self._bound(lo, hi, depth, wanted), self._bound(lo, hi, depth, wanted + 1)

    def _bound(self, lo, hi, depth, wanted):
        """Where the first suffix of each range is whose word at ``depth`` is not less."""
        lo, hi = lo.copy(), hi.copy()
        open_ = np.flatnonzero(lo < hi)
        last = self.words.size - 1
        while open_.size:
            middle = (lo[open_] + hi[open_]) >> 1
            less = self.words[np.minimum(self.places[middle] + depth, last)] < wanted[open_]
            lo[open_[less]] = middle[less] + 1
            hi[open_[~less]] = middle[~less]
            open_ = open_[lo[open_] < hi[open_]]
        return lo

    def occurrences(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the range, place) of all suffixes in the ranges ``[lo, hi)``."""
        size = hi - lo
        return np.repeat(np.arange(lo.size), size), self.places[ranges(lo, size)]


def _ranks(ordered: np.ndarray, places: np.ndarray) -> np.ndarray:
    """By place, the slot (from 1) of the first suffix with an equal first word; 0 for 0."""
    new = np.ones(ordered.size, bool)
    new[1:] = ordered[1:] != ordered[:-1]
    first = np.maximum.accumulate(np.where(new, np.arange(ordered.size), 0))
    rank = np.empty(ordered.size, np.int64)
    rank[places] = np.where(ordered > 0, first + 1, 0)
    return rank
