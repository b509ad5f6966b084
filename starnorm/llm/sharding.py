"""Byte-balanced shards of indivisible groups, by Karmarkar-Karp differencing.

Equal texts stay together: a group's size is the sum of its rows' sizes. A partial
partition is a tuple of shard sums; combining two adds the largest sums of one to the
smallest of the other, and always the two with the largest spread go first. Groups are
dealt into lots by a hash of their text; each lot is differenced in one task, and what
comes out, one partial partition a lot, is differenced again, in levels, until one is
left. Every level records how it permuted its inputs' shards, and groups look their
shard up through the levels. A lot holds a bounded number of groups, a level's task a
bounded number of partial partitions; nothing is collected.

A null text has no bytes and is a group of its own. Rows that are equal in all columns
are put together and numbered apart. Columns other than id and text are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starnorm.llm.ranks import number_within
from starnorm.operators.lookup import lookup
from starnorm.staging import staged

SHARDS = 40
ROW_BYTES = 16
# Groups differenced in one task, and partial partitions combined in one.
LOT_GROUPS = 20_000
FAN_IN = 1_000


def difference(tuples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Combine rows of shard sums into one.

    Returns the combined sums, least first, and for each input row the final shard of
    each of its places. Ties go by row number, so the result is repeatable.
    """
    n, k = tuples.shape
    heap = [(-int(row.max() - row.min()), i) for i, row in enumerate(tuples)]
    heapq.heapify(heap)
    sums = {i: np.sort(row, kind="stable") for i, row in enumerate(tuples)}
    # place[i][s]: where input place s of node i is after sorting that node
    place = {i: _places(row) for i, row in enumerate(tuples)}
    joined: list[tuple[int, int, int, np.ndarray]] = []
    node = n
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        total = sums.pop(a) + sums.pop(b)[::-1]
        joined.append((node, a, b, _places(total)))
        sums[node] = np.sort(total, kind="stable")
        heapq.heappush(heap, (-int(sums[node][-1] - sums[node][0]), node))
        node += 1
    last = heap[0][1]
    final = {last: np.arange(k)}
    for parent, a, b, moved in reversed(joined):
        to = final.pop(parent)[moved]  # final shard of each place before sorting
        final[a] = to
        final[b] = to[::-1]
    out = np.stack([final[i][place[i]] for i in range(n)])
    return sums[last], out


def _places(row: np.ndarray) -> np.ndarray:
    order = np.argsort(row, kind="stable")
    places = np.empty(row.size, np.int64)
    places[order] = np.arange(row.size)
    return places


def _level(nodes: DataFrame, n: int) -> DataFrame:
    """Combine partial partitions ``(node, sums)`` in tasks of about ``FAN_IN``.

    Returns (node, parent, place, sums): where each node's shards went in its parent,
    and, in one row with a null node, the parent's own sums.
    """
    tasks = max(1, -(-n // FAN_IN))

    def combine(table: pa.Table) -> pa.Table:
        table = table.sort_by("node")
        parent = table["parent"][0].as_py()
        sums = np.array(table["sums"].to_pylist(), np.int64)
        total, places = difference(sums)
        return pa.table(
            {
                "node": pa.array([*table["node"].to_pylist(), None], pa.int32()),
                "parent": pa.array([parent] * (len(places) + 1), pa.int32()),
                "place": pa.array([*places.tolist(), None], pa.list_(pa.int32())),
                "sums": pa.array([None] * len(places) + [total.tolist()], pa.list_(pa.int64())),
            }
        )

    dealt = nodes.select("node", "sums", F.expr(f"cast(node % {tasks} as int)").alias("parent"))
    schema = "node int, parent int, place array<int>, sums array<bigint>"
    return dealt.groupBy("parent").applyInArrow(combine, schema)


def assign(groups: DataFrame, n_groups: int, shards: int = SHARDS) -> DataFrame:
    """(key, size) of distinct keys -> (key, shard)."""
    n = max(1, -(-n_groups // LOT_GROUPS))

    def difference_lot(table: pa.Table) -> pa.Table:
        table = table.sort_by([("size", "descending"), ("key", "ascending")])
        single = np.zeros((table.num_rows, shards), np.int64)
        single[:, -1] = table["size"].to_numpy()
        total, places = difference(single)
        rows = table.num_rows
        return pa.table(
            {
                "lot": pa.array([table["lot"][0].as_py()] * (rows + 1), pa.int32()),
                "key": pa.array([*table["key"].to_pylist(), None], pa.binary()),
                "place": pa.array([*places[:, -1].tolist(), None], pa.int32()),
                "sums": pa.array([None] * rows + [total.tolist()], pa.list_(pa.int64())),
            }
        )

    lot = F.expr(f"cast(pmod(xxhash64(key), {n}) as int)").alias("lot")
    lots = (
        groups.select("key", "size", lot)
        .groupBy("lot")
        .applyInArrow(difference_lot, "lot int, key binary, place int, sums array<bigint>")
    )
    found = lots.where("sums is null").select("key", "lot", "place")
    nodes = lots.where("sums is not null").select(F.col("lot").alias("node"), "sums")
    while n > 1:
        level = _level(nodes, n)
        n = max(1, -(-n // FAN_IN))
        moves = level.where("sums is null").select(
            F.col("node").alias("lot"), "parent", F.col("place").alias("to")
        )
        found = found.join(moves, "lot").select(
            "key", F.col("parent").alias("lot"), F.expr("to[place]").alias("place")
        )
        nodes = level.where("sums is not null").select(F.col("parent").alias("node"), "sums")
    return found.select("key", F.col("place").cast("int").alias("shard"))


def shard_documents(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", shards: int = SHARDS
) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard) per input row.

    ``size`` is the text's UTF-8 bytes plus 16. ``slot`` numbers a shard's rows without
    gaps. The law is ``bytes``, so ``grown_shard`` is null.
    """
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(id_col).alias("id"),
        (F.length(raw) + F.lit(ROW_BYTES)).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        # A null text is no empty text: its key has no bytes, a digest has 32.
        F.coalesce(F.unhex(F.sha2(F.col(text), 256)), F.unhex(F.lit(""))).alias("key"),
    )
    grouped = rows.groupBy("key").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"))
    groups = staged(grouped, "groups")
    total = groups.agg(F.count(F.lit(1)).alias("groups"), F.sum("n").alias("rows")).first()
    shard_of = assign(groups.select("key", "size"), total["groups"], shards)
    # Copies of one text, or null texts, may be a third of all rows: they find their
    # shard where they are.
    counted = staged(shard_of.join(groups.select("key", "n"), "key"), "shard-of")
    placed = lookup(rows, counted, {"key": "key"}, {"shard": "shard"}, row_count="n")
    numbered = number_within(
        placed, "shard", ["id", "key"], "slot", total["rows"] or 0, F.xxhash64("id", "key")
    )
    return numbered.select(
        "id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
