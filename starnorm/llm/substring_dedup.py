"""Remove word windows that occur earlier in the corpus.

Two passes. The first merges count-min sketches of all blocks, which overestimate how
often each window occurs and so lose none that repeats. The second groups, exactly,
only the windows estimated to repeat: each block sends a window once, with the
smallest id it has there, and learns whether an earlier one exists elsewhere.

Windows are compared by a hash of 64 bits within a block, and by 96 bits of two
independent hashes between blocks. Order is (id, start); rows
with a null id come last, and rows that share an id count in the order of their block
and text, so of two equal rows one stays. Null texts have no words. Every input row
gives one output row; columns other than id and text are ignored.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from starnorm.llm.blocks import (
    NULL_LAST,
    SHARD_PIECES,
    blocked,
    ids_of,
    in_order,
    messages,
    pack_ids,
    pack_sorted,
    pow2,
    read_messages,
    shard_slices,
    text_size,
    unpack_ids,
    unpack_sorted,
)
from starnorm.llm.routes import network
from starnorm.llm.sketch import Sketch, merged
from starnorm.llm.spans import (
    SEEDS,
    covered,
    group_starts,
    hash_spans,
    per_row,
    runs,
    text_bytes,
    window_hash,
    windows_inside,
    word_spans,
)

WINDOW = 20
# Count-min rows, and counters per window in each: 1 in 16 unique windows passes by chance.
SKETCH_ROWS = 2
SKETCH_SPARE = 4

SCHEMA = (
    "id long, n_words long, n_removed long, kept_text string, "
    "removed array<struct<start: long, end: long>>"
)
_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])


class _Windows:
    """The windows of a block in (id, start) order, and its distinct ones by hash."""

    def __init__(self, table: pa.Table, k: int):
        self.table = in_order(table)
        self.data, self.offsets = text_bytes(self.table["text"])
        self.starts, ends, self.bounds = word_spans(self.data, self.offsets)
        h, g = hash_spans(self.data, self.starts, ends, SEEDS)
        self.at = windows_inside(self.bounds, k)
        h, g = window_hash(h, k)[self.at], window_hash(g, k, SEEDS[1])[self.at]
        self.order = np.argsort(h, kind="stable")
        h = h[self.order]
        self.first = group_starts(h)
        self.counts = np.diff(np.append(self.first, h.size))
        self.distinct = h[self.first]
        self.earliest = self.order[self.first]
        self.check = (g[self.earliest] & np.uint64(0xFFFFFFFF)).astype(np.uint32)

    def owners(self) -> np.ndarray:
        """The id of the row that holds each distinct window first."""
        rows = np.searchsorted(self.bounds, self.at[self.earliest], side="right") - 1
        return ids_of(self.table)[rows]


def _exact_shard(table: pa.Table) -> pa.Table:
    """Which of the windows sent by each block have an earlier holder."""
    found, parts = read_messages(table), []
    for block, _, payload in found:
        own, at = unpack_sorted(payload)
        high, at = unpack_sorted(payload, at)
        low = np.frombuffer(payload, np.uint32, own.size, at).astype(np.uint64)
        g = np.frombuffer(payload, np.uint32, own.size, at + 4 * own.size)
        holder = unpack_ids(payload, own.size, at + 8 * own.size)
        h = (high << np.uint64(32)) | low
        parts.append((own, h, g, holder, np.full(own.size, block, np.int64)))
    h, g, holder, blocks = (np.concatenate([p[k] for p in parts]) for k in (1, 2, 3, 4))
    order = np.lexsort((g, h))
    h, g, holder, blocks = h[order], g[order], holder[order], blocks[order]
    new = np.ones(h.size, bool)
    new[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, h.size))
    least = np.repeat(np.minimum.reduceat(holder, first), size)
    block_of = np.where(holder == least, blocks, NULL_LAST)
    winner = block_of == np.repeat(np.minimum.reduceat(block_of, first), size)
    later = np.empty(h.size, bool)
    later[order] = ~winner
    answers, at = [], 0
    for (block, shard, payload), part in zip(found, parts, strict=True):
        own = part[0][later[at : at + part[0].size]]
        at += part[0].size
        if own.size:
            limit = int(np.frombuffer(payload, np.int64, 2)[1])
            answers.append((block, shard, pack_sorted(own, limit)))
    return messages(answers)


def _kept(words: _Windows, removed: np.ndarray) -> list[bytes]:
    kept = ~removed
    raw, out = words.data.tobytes(), []
    for r in range(words.offsets.size - 1):
        own = raw[words.offsets[r] : words.offsets[r + 1]].split()
        flags = kept[words.bounds[r] : words.bounds[r + 1]]
        out.append(b" ".join(own if flags.all() else compress(own, flags)))
    return out


def remove_repeated_windows(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", window: int = WINDOW
) -> DataFrame:
    """Per row: id, words, words removed, the kept words joined by one space, and the
    removed runs as word ranges.

    A word goes if a window of ``window`` words that covers it starts earlier too.
    """
    _, size = text_size(docs, text)
    texts = blocked(docs, id_col, text, size)
    # A word and the space after it take two bytes at least; five is usual.
    sketch = Sketch(size // 5, SKETCH_ROWS, SKETCH_SPARE)
    shard_bits = pow2(-(-max(1, size // 10) // SHARD_PIECES))

    def sketched(table: pa.Table) -> pa.Table:
        block = table["block"][0].as_py()
        own = _Windows(table, window)
        return messages(list(sketch.parts(own.distinct, own.counts, block)))

    def suspects(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return messages([])
        block = table["block"][0].as_py()
        own = _Windows(table, window)
        repeated = np.flatnonzero(sketch.read(own.distinct, answers, levels=False))
        h, g, holder = own.distinct[repeated], own.check[repeated], own.owners()[repeated]
        out = []
        for shard, lo, hi in shard_slices(h, shard_bits):
            payload = (
                pack_sorted(repeated[lo:hi], own.distinct.size)
                + pack_sorted(h[lo:hi] >> np.uint64(32), 1 << 32)
                + (h[lo:hi] & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes()
                + g[lo:hi].tobytes()
                + pack_ids(holder[lo:hi])
            )
            out.append((block, shard, payload))
        return messages(out)

    def cleaned(table: pa.Table, answers: pa.Table) -> pa.Table:
        own = _Windows(table, window)
        later = np.zeros(own.distinct.size, bool)
        for _, _, payload in read_messages(answers):
            later[unpack_sorted(payload)[0].astype(np.int64)] = True
        drop = np.ones(own.at.size, bool)
        drop[own.earliest] = later
        begins = own.at[drop]
        removed = covered(begins, begins + window, own.starts.size)
        first, last, index = runs(removed, own.bounds)
        first_word = np.repeat(own.bounds[:-1], np.diff(index))
        spans = pa.StructArray.from_arrays(
            [pa.array(first - first_word), pa.array(last - first_word)], fields=list(_SPAN)
        )
        return pa.table(
            {
                "id": own.table["id"],
                "n_words": np.diff(own.bounds),
                "n_removed": per_row(removed, own.bounds),
                "kept_text": pa.array(_kept(own, removed), pa.binary()).cast(pa.string()),
                "removed": pa.ListArray.from_arrays(pa.array(index, pa.int32()), spans),
            }
        )

    route = network(size, max(sketch.shards, 1 << shard_bits))
    parts = route.from_blocks(texts, sketched)
    estimates = route.at_shards(parts, lambda t: merged(t, levels=False))
    sent = route.by_block(texts, estimates, suspects)
    later = route.at_shards(sent, _exact_shard)
    return route.by_block(texts, later, cleaned, SCHEMA)
