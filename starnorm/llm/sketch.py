"""A count-min sketch merged from the sketches of all blocks.

Each row of the sketch has ``1 << bits`` counters. A block's part of it is sparse:
the counters it touched, sorted and packed, with their counts. The merged counters
never undercount a piece, so what they call unique is unique. The merged sketch is
spread over shards of counters and never assembled; a shard answers each block for
the counters that block touched.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from starnorm.llm.blocks import (
    SHARD_PIECES,
    messages,
    pack_sorted,
    pow2,
    read_messages,
    unpack_sorted,
)
from starnorm.llm.spans import group_starts, mixed

_ROW = 1 << 24  # shards of sketch row r are numbered from r * _ROW
_SATURATED = 255


class Sketch:
    """Layout for about ``pieces`` distinct pieces, ``spare`` counters for each and row."""

    def __init__(self, pieces: int, depth: int, spare: int, base: int = 0):
        self.depth = depth
        self.base = base  # the number of the first shard
        self.bits = max(8, pow2(max(1, pieces) * spare))
        self.shard_bits = min(self.bits - 8, pow2(-(-max(1, pieces) // SHARD_PIECES)))

    def cells(self, hashes: np.ndarray, row: int) -> np.ndarray:
        salted = hashes + np.uint64((row + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))
        return mixed(salted) >> np.uint64(64 - self.bits)

    def parts(self, hashes: np.ndarray, counts: np.ndarray, block: int):
        """Messages with this block's counters, from distinct hashes and their counts."""
        width = self.bits - self.shard_bits
        for row in range(self.depth):
            cells = self.cells(hashes, row)
            order = np.argsort(cells)
            cells = cells[order]
            first = group_starts(cells)
            totals = np.add.reduceat(counts[order], first) if first.size else counts[:0]
            cells = cells[first]
            totals = np.minimum(totals, _SATURATED).astype(np.uint8)
            shards = cells >> np.uint64(width)
            cut = group_starts(shards)
            for lo, hi in zip(cut, np.append(cut[1:], shards.size), strict=True):
                low = cells[lo:hi] & np.uint64((1 << width) - 1)
                many = totals[lo:hi] > 1
                payload = (
                    pack_sorted(low, 1 << width)
                    + np.packbits(many).tobytes()
                    + totals[lo:hi][many].tobytes()
                )
                yield block, self.base + row * _ROW + int(shards[lo]), payload

    @property
    def shards(self) -> int:
        return self.depth << self.shard_bits

    def read(self, hashes: np.ndarray, answers: pa.Table, *, levels: bool) -> np.ndarray:
        """The estimate for each of this block's hashes: the least over the rows.

        A level, or whether the count may be two or more.
        """
        lowest = np.full(hashes.size, _SATURATED, np.uint8)
        found = [(shard - self.base, payload) for _, shard, payload in read_messages(answers)]
        for row in range(self.depth):
            cells = self.cells(hashes, row)
            order = np.argsort(cells)
            first = group_starts(cells[order])
            sizes = np.diff(np.append(first, cells.size))
            own = cells[order][first] >> np.uint64(self.bits - self.shard_bits)
            coded = np.empty(first.size, np.uint8)
            for shard, payload in found:
                if shard // _ROW == row:
                    lo, hi = np.searchsorted(own, np.array([shard % _ROW, shard % _ROW + 1], np.uint64))
                    raw = np.frombuffer(payload, np.uint8)
                    coded[lo:hi] = raw if levels else np.unpackbits(raw, count=hi - lo)
            spread = np.empty(cells.size, np.uint8)
            spread[order] = np.repeat(coded, sizes)
            np.minimum(lowest, spread, out=lowest)
        return lowest if levels else lowest.astype(bool)


def merged(table: pa.Table, *, levels: bool) -> pa.Table:
    """Answer the messages of one shard with the merged counters of their cells.

    ``levels``: as the whole binary logarithm of the count, in a byte; else one bit, set
    where the count is two or more.
    """
    found, cells, counts = read_messages(table), [], []
    for _, _, payload in found:
        own, at = unpack_sorted(payload)
        n_bytes = -(-own.size // 8)
        flags = np.frombuffer(payload, np.uint8, n_bytes, at)
        many = np.unpackbits(flags, count=own.size).astype(bool)
        count = np.ones(own.size, np.int64)
        count[many] = np.frombuffer(payload, np.uint8, offset=at + n_bytes)
        cells.append(own)
        counts.append(count)
    sizes = [c.size for c in cells]
    cell = np.concatenate(cells)
    order = np.argsort(cell)
    first = group_starts(cell[order])
    totals = np.add.reduceat(np.concatenate(counts)[order], first)
    estimate = np.empty(cell.size, np.int64)
    estimate[order] = np.repeat(totals, np.diff(np.append(first, cell.size)))
    coded = np.log2(estimate).astype(np.uint8) if levels else None
    answers, at = [], 0
    for (block, shard, _), size in zip(found, sizes, strict=True):
        part = slice(at, at + size)
        payload = np.packbits(estimate[part] > 1) if coded is None else coded[part]
        answers.append((block, shard, payload.tobytes()))
        at += size
    return messages(answers)
