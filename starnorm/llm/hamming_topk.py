"""Exact top-k search over binary codes by incremental multi-index hashing.

A vector's code has one bit per component, set where it is positive. Codes are cut into
m segments, each with a table from its value to the codes that have it. A query looks
up its own segments first, then one segment after the other with one more bit flipped.
After step s, which searches radius s // m in segment s % m, every code at distance s
or less has been met: one missed would differ by more in each segment. So a query is
done when its k-th verified distance is no larger than the last step.

Equal vectors are one code with its smallest ids, so a group of copies is one entry.
Distinct codes are dealt into blocks by a hash, and queries too; a task searches one
block of codes for one block of queries, and the best k of all blocks are the answer.
Queries are a stated set of rows; they search all rows, themselves included.

Order is (distance, id), null ids last. Vectors that are null are not searched and find
nothing; null or NaN components give no bit; shorter vectors end in zero bits. Columns
other than id and vector are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 10
# Codes and queries searched in one task at most, and codes below which no cut is made.
INDEX_CODES = 1 << 18
QUERY_CODES = 1 << 12
SMALL_CODES = 1 << 12
MOST_SMALL_BLOCKS = 64
# Candidates looked at together.
CANDIDATES = 1 << 20


def codes(vectors: DataFrame, id_col: str, vector: str, n_bits: int) -> DataFrame:
    """(id, code) of rows with a vector."""
    width = -(-n_bits // 64) * 8

    def coded(batches):
        for batch in batches:
            column = batch.column(1)
            lists = pa.array(column)
            size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            values = lists.flatten().fill_null(0).to_numpy(zero_copy_only=False)
            bits = np.zeros((len(lists), width * 8), bool)
            row = np.repeat(np.arange(len(lists)), size)
            at = np.arange(row.size) - np.repeat(np.cumsum(size) - size, size)
            bits[row, at] = values > 0
            packed = np.packbits(bits, axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([p.tobytes() for p in packed], pa.binary())],
                names=["id", "code"],
            )

    present = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(vector).alias("vector")
    ).where("vector IS NOT NULL")
    return present.mapInArrow(coded, "id long, code binary")


class CodeIndex:
    """Tables over the segments of distinct codes, given in the order that settles ties."""

    def __init__(self, packed: np.ndarray, n_bits: int):
        self.packed, self.n_bits = packed, n_bits
        self.words = np.ascontiguousarray(packed).view(np.uint64)
        wanted = int(np.clip(np.ceil(np.log2(max(packed.shape[0], 2))), 4, 16))
        self.m = max(1, -(-n_bits // wanted))
        cuts = np.linspace(0, n_bits, self.m + 1).astype(int)
        self.segments = list(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))
        self.tables = []
        for values, (lo, hi) in zip(self._values(packed), self.segments, strict=True):
            order = np.argsort(values, kind="stable")
            starts = np.searchsorted(values[order], np.arange((1 << (hi - lo)) + 1))
            self.tables.append((order, starts))

    def _values(self, packed: np.ndarray) -> list[np.ndarray]:
        bits = np.unpackbits(packed, axis=1, count=self.n_bits).astype(np.int64)
        return [bits[:, lo:hi] @ (1 << np.arange(hi - lo)) for lo, hi in self.segments]

    def search(self, packed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, code, distance) of each query's first k codes by (distance, code)."""
        queries = np.ascontiguousarray(packed).view(np.uint64)
        values = self._values(packed)
        k = min(k, self.words.shape[0])
        best = np.zeros(0, np.uint64)  # query, distance and code in one number
        open_queries = np.arange(packed.shape[0])
        for step in range(self.n_bits + self.m):
            if not open_queries.size:
                break
            segment, radius = step % self.m, step // self.m
            lo, hi = self.segments[segment]
            if radius > hi - lo:
                continue
            flips = np.array([sum(1 << b for b in c) for c in combinations(range(hi - lo), radius)])
            order, starts = self.tables[segment]
            each = max(1, CANDIDATES // max(1, flips.size))
            for at in range(0, open_queries.size, each):
                own = open_queries[at : at + each]
                wanted = (values[segment][own][:, None] ^ flips).ravel()
                size = starts[wanted + 1] - starts[wanted]
                owner = np.repeat(own, flips.size)
                best = self._better(best, queries, owner, starts[wanted], size, order, k)
            open_queries = self._uncovered(best, open_queries, step, k)
        return self._unpacked(best)

    def _better(self, best, queries, owner, first, size, order, k) -> np.ndarray:
        limits = np.cumsum(size)
        lo = 0
        while lo < owner.size:
            done = limits[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(limits, done + CANDIDATES, side="right")))
            own = size[lo:hi]
            within = np.arange(int(own.sum())) - np.repeat(np.cumsum(own) - own, own)
            code = order[np.repeat(first[lo:hi], own) + within]
            query = np.repeat(owner[lo:hi], own)
            apart = np.bitwise_count(queries[query] ^ self.words[code]).sum(axis=1)
            best = _first_k(np.concatenate([best, _packed(query, apart, code)]), k)
            lo = hi
        return best

    def _uncovered(self, best, open_queries, step, k) -> np.ndarray:
        query, _, distance = self._unpacked(best)
        met = np.bincount(query[distance <= step], minlength=int(open_queries.max()) + 1)
        return open_queries[met[open_queries] < k]

    @staticmethod
    def _unpacked(best):
        return (
            (best >> np.uint64(44)).astype(np.int64),
            (best & np.uint64((1 << 28) - 1)).astype(np.int64),
            (best >> np.uint64(28) & np.uint64(0xFFFF)).astype(np.int64),
        )


def _packed(query: np.ndarray, distance: np.ndarray, code: np.ndarray) -> np.ndarray:
    """20 bits of query, 16 of distance and 28 of code: numbers sort as the triples do."""
    high = query.astype(np.uint64) << np.uint64(44) | distance.astype(np.uint64) << np.uint64(28)
    return high | code.astype(np.uint64)


def _first_k(found: np.ndarray, k: int) -> np.ndarray:
    """The k smallest distinct numbers of each query."""
    found = np.sort(found)
    new = np.ones(found.size, bool)
    new[1:] = found[1:] != found[:-1]
    found = found[new]
    query = found >> np.uint64(44)
    first = np.searchsorted(query, query, side="left")
    return found[np.arange(found.size) - first < k]


def _search_block(index: pa.Table, queries: pa.Table, n_bits: int, k: int) -> pa.Table:
    names = ["query", "ids", "distance"]
    types = [pa.binary(), pa.list_(pa.int64()), pa.int32()]
    if not index.num_rows or not queries.num_rows:
        return pa.table([pa.array([], t) for t in types], names=names)
    # Codes in the order of their smallest ids, which settles ties; null ids come last.
    ids = index["ids"].combine_chunks()
    raw = index["code"].to_pylist()
    least = [own[0] for own in ids.to_pylist()]
    order = np.array(
        sorted(range(len(raw)), key=lambda i: (least[i] is None, least[i] or 0, raw[i]))
    )
    packed = np.stack([np.frombuffer(raw[i], np.uint8) for i in order])
    asked = queries["query"].to_pylist()
    wanted = np.stack([np.frombuffer(q, np.uint8) for q in asked])
    query, code, distance = CodeIndex(packed, n_bits).search(wanted, k)
    return pa.table(
        [
            pa.array([asked[q] for q in query], pa.binary()),
            ids.take(pa.array(order[code])),
            pa.array(distance, pa.int32()),
        ],
        names=names,
    )


def top_k(
    vectors: DataFrame,
    queries: Column,
    id_col: str = "vec_id",
    vector: str = "embedding",
    k: int = K,
) -> DataFrame:
    """(query_id, rank, id, distance): the k nearest rows of each row that ``queries`` picks."""
    n_bits = vectors.agg(F.max(F.size(vector))).first()[0] or 0
    n_bits = max(1, n_bits)
    if n_bits >= 1 << 16:
        raise ValueError("codes have fewer than 65,536 bits")
    rows = codes(vectors, id_col, vector, n_bits)
    asking = codes(vectors.where(queries), id_col, vector, n_bits)
    # A code needs no more than its k smallest ids.
    turn = Window.partitionBy("code").orderBy(F.col("id").asc_nulls_last())
    distinct = (
        rows.withColumn("turn", F.row_number().over(turn))
        .where(F.col("turn") <= k)
        .groupBy("code")
        .agg(F.sort_array(F.collect_list(F.struct("turn", "id"))).alias("turns"))
        .select("code", F.expr("transform(turns, t -> t.id)").alias("ids"))
    )
    asked = asking.select(F.col("code").alias("query")).distinct()
    n_codes = rows.count()
    n_asked = asked.count()
    index_blocks = max(
        -(-n_codes // INDEX_CODES), min(MOST_SMALL_BLOCKS, -(-n_codes // SMALL_CODES)), 1
    )
    query_blocks = max(1, -(-n_asked // QUERY_CODES))
    of_index = F.pmod(F.xxhash64("code"), F.lit(index_blocks)).cast("int").alias("i")
    of_query = F.pmod(F.xxhash64("query"), F.lit(query_blocks)).cast("int").alias("q")
    left = distinct.select(
        of_index, F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("q"), "code", "ids"
    )
    right = asked.select(
        F.explode(F.sequence(F.lit(0), F.lit(index_blocks - 1))).alias("i"), of_query, "query"
    )
    # A task for each pair of blocks, however few bytes they have.
    tasks = index_blocks * query_blocks
    found = (
        left.repartition(tasks, "i", "q")
        .groupBy("i", "q")
        .cogroup(right.repartition(tasks, "i", "q").groupBy("i", "q"))
        .applyInArrow(
            lambda index, wanted: _search_block(index, wanted, n_bits, k),
            "query binary, ids array<bigint>, distance int",
        )
    )
    near = Window.partitionBy("query").orderBy("distance", F.col("id").asc_nulls_last())
    ranked = (
        found.select("query", "distance", F.explode("ids").alias("id"))
        .withColumn("rank", F.row_number().over(near))
        .where(F.col("rank") <= k)
    )
    return (
        asking.select(F.col("id").alias("query_id"), F.col("code").alias("query"))
        .join(ranked, "query")
        .select("query_id", "rank", "id", "distance")
    )
