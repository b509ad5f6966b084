"""Vectorised views of UTF-8 texts inside Arrow batches: words, lines and their hashes."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa

SPACE_BYTES = b"\x20\x09\x0a\x0b\x0c\x0d"
IS_SPACE = np.isin(np.arange(256), list(SPACE_BYTES))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

SEEDS = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)
# The vectorised loop over spans runs once per 8 bytes of the longest.
LOOP_BYTES = 256
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, bounds, data = column.buffers()
    offsets = np.frombuffer(bounds, np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits, in place."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_spans(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = IS_SPACE):
    """Starts and ends of all words, and the index of each row's first word.

    The third array has one more entry than there are rows. ``between`` tells for each
    byte whether it stands between words.
    """
    word = ~between[data]
    filled = offsets[1:] > offsets[:-1]
    row_first, row_last = offsets[:-1][filled], offsets[1:][filled] - 1
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    first[row_first] = word[row_first]
    last[:-1] &= ~word[1:]
    last[row_last] = word[row_last]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def line_spans(data: np.ndarray, offsets: np.ndarray):
    """Like ``word_spans`` for the pieces between newlines; empty lines count."""
    breaks = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    # A break at the end of a row starts that row's last, empty line, which sorts before
    # the next row's first line at the same place.
    rows = offsets.size - 1
    n_lines = 1 + np.searchsorted(breaks, offsets[1:]) - np.searchsorted(breaks, offsets[:-1])
    bounds = np.concatenate([[0], np.cumsum(n_lines)]) if rows else np.zeros(1, np.int64)
    ends = np.empty_like(starts)
    if rows:
        ends[:-1] = starts[1:] - 1
        ends[bounds[1:] - 1] = offsets[1:]
    return starts, ends, bounds


def strided(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on, as one little-endian number."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray(shape=(data.size + 1,), dtype="<u8", buffer=padded, strides=(1,))


def hash_spans(
    data: np.ndarray,
    starts: np.ndarray,
    ends: np.ndarray,
    seeds: tuple[int, ...] = SEEDS[:1],
    loop_bytes: int = LOOP_BYTES,
) -> list[np.ndarray]:
    """One 64-bit hash per span and seed.

    Spans longer than ``loop_bytes`` are hashed one at a time.
    """
    eight = strided(data)
    length = ends - starts
    hashes = [mixed(length.astype(np.uint64) + np.uint64(seed)) for seed in seeds]
    short = length <= loop_bytes
    active = np.flatnonzero(short & (length > 0))
    at = 0
    while active.size:
        left = length[active] - at
        chunk = eight[starts[active] + at] & _MASKS[np.minimum(left, 8)]
        for k, h in enumerate(hashes):
            h[active] = mixed((h[active] ^ chunk) * np.uint64(SEEDS[k]))
        at += 8
        active = active[left > 8]
    for i in np.flatnonzero(~short):
        digest = blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=16).digest()
        for k, h in enumerate(hashes):
            h[i] = int.from_bytes(digest[8 * k : 8 * k + 8], "little")
    return hashes


def window_hash(h: np.ndarray, k: int, seed: int = SEEDS[0]) -> np.ndarray:
    """Hash of each run of ``k`` consecutive entries, row limits not regarded."""
    n = max(0, h.size - k + 1)
    out = np.full(n, seed, np.uint64)
    for j in range(k):
        out *= np.uint64(0x2545F4914F6CDD1D)
        out += h[j : j + n]
    return mixed(out)


def windows_inside(bounds: np.ndarray, k: int) -> np.ndarray:
    """Indices of the windows of ``k`` entries that lie inside one row."""
    counts = np.maximum(0, np.diff(bounds) - k + 1)
    return ranges(bounds[:-1], counts)


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``starts[i], starts[i] + 1, ...`` for ``counts[i]`` entries each, concatenated."""
    total = int(counts.sum())
    shift = starts - (np.cumsum(counts) - counts)
    return np.arange(total, dtype=np.int64) + np.repeat(shift, counts)


def row_slices(offsets: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes; a longer row is a range of its own."""
    rows, lo = offsets.size - 1, 0
    while lo < rows:
        hi = int(np.searchsorted(offsets, offsets[lo] + size, side="right")) - 1
        hi = min(max(hi, lo + 1), rows)
        yield lo, hi
        lo = hi


def per_row(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` over each row's entries."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def group_starts(sorted_values: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    if not sorted_values.size:
        return np.zeros(0, np.int64)
    new = np.empty(sorted_values.size, bool)
    new[0] = True
    np.not_equal(sorted_values[1:], sorted_values[:-1], out=new[1:])
    return np.flatnonzero(new)


def covered(starts: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """Which of ``size`` places lie in any interval ``[start, end)``."""
    steps = np.bincount(starts, minlength=size + 1) - np.bincount(ends, minlength=size + 1)
    return np.cumsum(steps[:size]) > 0


def runs(flags: np.ndarray, bounds: np.ndarray):
    """Maximal runs of true flags inside rows: starts and ends, and their index per row."""
    first, last = flags.copy(), flags.copy()
    filled = bounds[1:] > bounds[:-1]
    row_first, row_last = bounds[:-1][filled], bounds[1:][filled] - 1
    first[1:] &= ~flags[:-1]
    first[row_first] = flags[row_first]
    last[:-1] &= ~flags[1:]
    last[row_last] = flags[row_last]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, bounds)
