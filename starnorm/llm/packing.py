"""Best-fit packing planned on a histogram of lengths.

Documents are cut into pieces of at most ``CAPACITY`` tokens. Only the number of
pieces of each length is needed to plan: best-fit decreasing runs over the histogram,
in ranges of alike sequences, on the driver. The plan says which ranks of a length go
to which sequences at which offset. Its size is bounded by the capacity, not by the
data. Pieces then take their slots by joining on their rank within their length.

A null text counts as empty: it has the closing token alone. Columns other than id and
text are ignored; equal rows are packed apart.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starnorm.llm import vocabulary
from starnorm.llm.ranks import number_within
from starnorm.staging import staged

CAPACITY = 2048
CLOSING_ID = 0


class Slot(NamedTuple):
    """Where pieces of one length with ranks from ``first`` up to ``last`` go.

    ``each`` of them, in the order of their ranks, fill one sequence after the other
    from ``sequence`` on, starting at ``offset``.
    """

    length: int
    first: int
    last: int
    sequence: int
    offset: int
    each: int


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Slot]:
    """Best-fit decreasing over counts.

    Longer pieces go first, each into the fullest open sequence that still holds it;
    what finds no room opens a new one. Sequences with equal room form ranges, which a
    length takes whole but for the last.
    """
    room: dict[int, list[tuple[int, int]]] = defaultdict(list)  # free tokens -> (start, size)
    slots, opened = [], 0
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        for free in range(length, capacity + 1):
            while left and room[free]:
                placed = _place(room, slots, length, rank, left, *room[free].pop(), free, capacity)
                rank, left = rank + placed, left - placed
        if left:
            new = -(-left // (capacity // length))
            _place(room, slots, length, rank, left, opened, new, capacity, capacity)
            opened += new
    return slots


def _place(room, slots, length, rank, left, start, size, free, capacity) -> int:
    """Put up to ``left`` pieces into a range of ``size`` sequences; how many went in."""
    each, offset = free // length, capacity - free
    full = min(size, left // each)
    if full:
        slots.append(Slot(length, rank, rank + full * each, start, offset, each))
        room[free - each * length].append((start, full))
    placed, used = full * each, full
    rest = left - placed
    if rest and full < size:
        slots.append(Slot(length, rank + placed, rank + left, start + full, offset, each))
        room[free - rest * length].append((start + full, 1))
        placed, used = left, full + 1
    if used < size:
        room[free].append((start + used, size - used))
    return placed


def pieces_of(spark: SparkSession, path: str | None = None, capacity: int = CAPACITY):
    """A function from a text column to its pieces: start, length, and a digest of the ids."""
    path = path or vocabulary.default_path()
    schema = "array<struct<piece: int, start: long, length: long, ids_crc32: long>>"
    fields = [
        pa.field("piece", pa.int32()),
        pa.field("start", pa.int64()),
        pa.field("length", pa.int64()),
        pa.field("ids_crc32", pa.int64()),
    ]

    @F.arrow_udf(schema)
    def pieces(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows, index = [], [0]
            for ids in encoded(batch, path):
                first = ids.size % capacity or capacity
                cuts = [0, *range(min(first, ids.size), ids.size + 1, capacity)]
                for k, (lo, hi) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    rows.append((k, lo, hi - lo, zlib.crc32(ids[lo:hi])))
                index.append(len(rows))
            columns = list(zip(*rows, strict=True)) or [()] * 4
            arrays = [pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)]
            structs = pa.StructArray.from_arrays(arrays, fields=fields)
            yield pa.ListArray.from_arrays(pa.array(index, pa.int32()), structs)

    return pieces


def encoded(texts: pa.Array, path: str, closing: int = CLOSING_ID) -> Iterator[np.ndarray]:
    """The ids of each text, with the closing id, as little-endian 32-bit numbers."""
    known = vocabulary.load(path)
    for text in texts:
        yield np.append(known.encode(text.as_py() or ""), closing).astype("<u4")


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    path: str | None = None,
    capacity: int = CAPACITY,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset) per piece."""
    spark = docs.sparkSession
    cut = pieces_of(spark, path, capacity)(F.col(text))
    # Written once: texts are tokenized for the histogram and for the result alike.
    pieces = staged(
        docs.select(
            F.col(id_col).alias("id"),
            F.xxhash64(F.col(id_col), F.col(text)).alias("_key"),
            cut.alias("_cut"),
            # Every text has a piece. From a plain inline Spark would infer a filter on the
            # pieces, and evaluate them twice.
        ).select("id", "_key", F.inline_outer("_cut")),
        "pieces",
    )
    counts = pieces.groupBy("length").count().collect()  # one row a length
    histogram = {row["length"]: row["count"] for row in counts}
    ranked = number_within(
        pieces,
        "length",
        ["_key", "piece"],
        "_rank",
        sum(histogram.values()),
        F.xxhash64("_key", "piece"),
    )
    slots = spark.createDataFrame(
        plan(histogram, capacity),
        "length long, _first long, _last long, _sequence long, _offset long, _each long",
    )
    inside = F.col("_rank").between(F.col("_first"), F.col("_last") - 1)
    turn = F.col("_rank") - F.col("_first")
    return (
        # The plan's size depends on the capacity alone.
        ranked.join(F.broadcast(slots.withColumnRenamed("length", "_length")), [
            F.col("length") == F.col("_length"), inside
        ])
        .select(
            "id",
            "piece",
            "start",
            "length",
            "ids_crc32",
            (F.col("_sequence") + F.expr("(_rank - _first) div _each")).alias("sequence_id"),
            (F.col("_offset") + turn % F.col("_each") * F.col("length")).alias("offset"),
        )
    )
