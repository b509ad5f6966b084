"""Texts in blocks, and compact messages between blocks and shards of a key space.

Several operators ask a global question about small pieces of text (is this window
anywhere else?). A block of texts sends its distinct pieces, sorted and packed, to
the shards that own them; a shard merges what all blocks sent and answers each. The
texts themselves are shuffled once: the exchange into blocks is the same plan every
time a block is read, and Spark reuses it. Nothing passes through the driver. A piece
that fills a third of the corpus reaches its shard once per block, not once per row.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starnorm.sizing import SHUFFLE_BYTES

# Text in a block: what a task holds in memory, with its hashes.
BLOCK_BYTES = 4 << 20
# Pieces one shard merges at a time.
SHARD_PIECES = 2_000_000

NULL_LAST = np.iinfo(np.int64).max

MESSAGE = "block int, shard int, payload binary"
ARROW_MESSAGE = pa.schema([("block", pa.int32()), ("shard", pa.int32()), ("payload", pa.binary())])


def text_size(docs: DataFrame, text: str) -> tuple[int, int]:
    """Rows and text bytes, by one scan."""
    row = docs.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(F.octet_length(text).cast("long")), F.lit(0)).alias("size"),
    ).first()
    return row["rows"], row["size"]


def pow2(n: int) -> int:
    """Bits needed so that ``1 << bits`` is at least ``n``."""
    return max(0, int(n - 1).bit_length())


def n_blocks(size: int) -> int:
    return max(1, -(-size // BLOCK_BYTES))


def blocked(
    docs: DataFrame, id_col: str, text: str, size: int, carry: Sequence[str] = ()
) -> DataFrame:
    """(block, id, text, print), dealt out by a hash of id and text.

    The hash makes a row's block independent of how the input is partitioned, so a
    task that is run again after an executor was lost builds the same block. Rows
    that share an id, null included, spread as far as their texts differ. ``print`` is
    a hash of the text; ``carry`` names columns to take along in a struct ``row``.
    """
    n = n_blocks(size)
    columns = [
        F.col(id_col).cast("long").alias("id"),
        F.col(text).cast("string").alias("text"),
        F.xxhash64(F.col(text)).alias("print"),
    ]
    if carry:
        columns.append(F.struct(*[F.col(quoted(c)).alias(c) for c in carry]).alias("row"))
    block = F.pmod(F.xxhash64("id", "print"), F.lit(n)).cast("int").alias("block")
    # A task takes some blocks, one after the other; small inputs still feed all cores.
    cores = docs.sparkSession.sparkContext.defaultParallelism
    parts = max(-(-size // SHUFFLE_BYTES), min(n, 4 * cores))
    return docs.select(*columns).select(block, "*").repartition(parts, "block")


def quoted(name: str) -> str:
    """A column name taken literally, dots and spaces included."""
    return "`" + name.replace("`", "``") + "`"


def in_order(table: pa.Table) -> pa.Table:
    """A block's rows by id (null last), then text: the same order in every run."""
    return table.sort_by([("id", "ascending"), ("text", "ascending")])


def ids_of(table: pa.Table) -> np.ndarray:
    return table["id"].fill_null(NULL_LAST).to_numpy().astype(np.int64)


def shard_slices(sorted_values: np.ndarray, bits: int):
    """(shard, lo, hi) of sorted 64-bit values, by their top ``bits`` bits."""
    n = 1 << bits
    if bits == 0:
        limits = np.array([0, sorted_values.size])
    else:
        tops = np.arange(1, n, dtype=np.uint64) << np.uint64(64 - bits)
        inner = np.searchsorted(sorted_values, tops)
        limits = np.concatenate([[0], inner, [sorted_values.size]])
    for shard in np.flatnonzero(np.diff(limits)):
        yield int(shard), int(limits[shard]), int(limits[shard + 1])


def messages(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    blocks, shards, payloads = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.table(
        [pa.array(blocks, pa.int32()), pa.array(shards, pa.int32()), pa.array(payloads, pa.binary())],
        schema=ARROW_MESSAGE,
    )


def read_messages(table: pa.Table) -> list[tuple[int, int, bytes]]:
    """Messages in a fixed order."""
    found = zip(
        table["block"].to_pylist(),
        table["shard"].to_pylist(),
        table["payload"].to_pylist(),
        strict=True,
    )
    return sorted(found, key=lambda m: m[:2])


def pack_sorted(values: np.ndarray, limit: int) -> bytes:
    """Non-decreasing integers below ``limit``: high parts in unary, low bits as they are."""
    m = values.size
    low = max(0, int(limit // max(m, 1)).bit_length() - 1)
    head = np.array([m, limit, low], np.int64).tobytes()
    if not m:
        return head
    values = values.astype(np.uint64)
    high = (values >> np.uint64(low)).astype(np.int64) + np.arange(m)
    bits = np.zeros((limit >> low) + m + 1, bool)
    bits[high] = True
    return head + np.packbits(bits).tobytes() + _pack_low(values, low)


def unpack_sorted(payload: bytes, at: int = 0) -> tuple[np.ndarray, int]:
    """The integers of ``pack_sorted`` and where the payload goes on."""
    m, limit, low = (int(x) for x in np.frombuffer(payload, np.int64, 3, at))
    at += 24
    if not m:
        return np.zeros(0, np.uint64), at
    size = (limit >> low) + m + 1
    bits = np.unpackbits(np.frombuffer(payload, np.uint8, -(-size // 8), at), count=size)
    at += -(-size // 8)
    values = np.flatnonzero(bits).astype(np.uint64) - np.arange(m, dtype=np.uint64)
    values <<= np.uint64(low)
    at = _unpack_low(payload, at, low, values)
    return values, at


def _pack_low(values: np.ndarray, low: int) -> bytes:
    """The ``low`` lowest bits: whole bytes first, then what is left, bit by bit."""
    out = b""
    for k in range(low // 8):
        out += (values >> np.uint64(8 * k)).astype(np.uint8).tobytes()
    left = low % 8
    if left:
        rest = (values >> np.uint64(low - left)).astype(np.uint8)
        bits = np.unpackbits(rest[:, None], axis=1, count=left, bitorder="little")
        out += np.packbits(bits).tobytes()
    return out


def _unpack_low(payload: bytes, at: int, low: int, values: np.ndarray) -> int:
    m = values.size
    for k in range(low // 8):
        part = np.frombuffer(payload, np.uint8, m, at).astype(np.uint64)
        values |= part << np.uint64(8 * k)
        at += m
    left = low % 8
    if left:
        n_bytes = -(-m * left // 8)
        bits = np.unpackbits(np.frombuffer(payload, np.uint8, n_bytes, at), count=m * left)
        rest = np.packbits(bits.reshape(m, left), axis=1, bitorder="little").ravel()
        values |= rest.astype(np.uint64) << np.uint64(low - left)
        at += n_bytes
    return at


def pack_ids(ids: np.ndarray) -> bytes:
    """Ids as distances from the smallest, in four bytes each where they fit."""
    least = int(ids.min(initial=NULL_LAST))
    apart = ids.astype(np.uint64) - np.uint64(least & (2**64 - 1))
    width = 4 if apart.max(initial=0) < 2**32 else 8
    return np.array([least, width], np.int64).tobytes() + apart.astype(f"u{width}").tobytes()


def unpack_ids(payload: bytes, size: int, at: int) -> np.ndarray:
    least, width = (int(x) for x in np.frombuffer(payload, np.int64, 2, at))
    apart = np.frombuffer(payload, f"u{width}", size, at + 16).astype(np.uint64)
    return (apart + np.uint64(least & (2**64 - 1))).astype(np.int64)


def unused_name(wanted: str, taken: list[str]) -> str:
    """``wanted``, made longer until no column in ``taken`` has that name."""
    names = {t.lower() for t in taken}
    while wanted.lower() in names:
        wanted += "_"
    return wanted
