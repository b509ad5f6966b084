"""Ways for messages between many blocks and many shards.

Sent straight, every block has a message for every shard, and as both grow with the
input the messages grow with its square. Beyond ``1 << FAN_BITS`` receivers messages
travel in hops instead: a sender bundles what it has by the next ``FAN_BITS`` bits of
the receiver's number, a relay merges the bundles of as many senders and sorts them by
the next bits, and so on. A node never has more than ``1 << FAN_BITS`` bundles to send
and holds about as much as a block sends, so messages grow in proportion to the input,
times the hops.

What the functions at both ends see is the same either way.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from starnorm.llm.blocks import MESSAGE, messages, n_blocks, pow2, read_messages
from starnorm.sizing import SHUFFLE_BYTES

# Receivers that a sender addresses one by one, as a power of two.
FAN_BITS = 10

Message = tuple[int, int, bytes]
Function = Callable[..., pa.Table]
BLOCK, SHARD = 0, 1
_NAMES = ("block", "shard")


def _slot(number: int, bits: int) -> int:
    """The first ``bits`` bits of a number's hash."""
    return ((number * 0x9E3779B1) & 0xFFFFFFFF) >> (32 - bits) if bits else 0


def bundled(found: Iterable[Message]) -> bytes:
    found = list(found)
    head = np.array([len(found)], np.int64).tobytes()
    ends = np.array([m[:2] for m in found], np.int32).reshape(-1, 2).tobytes()
    sizes = np.array([len(m[2]) for m in found], np.int64).tobytes()
    return b"".join([head, ends, sizes, *(m[2] for m in found)])


def opened(bundle: bytes) -> list[Message]:
    n = int(np.frombuffer(bundle, np.int64, 1)[0])
    ends = np.frombuffer(bundle, np.int32, 2 * n, 8).reshape(-1, 2)
    sizes = np.frombuffer(bundle, np.int64, n, 8 + 8 * n)
    stops = 8 + 16 * n + np.cumsum(sizes)
    return [
        (block, shard, bundle[stop - size : stop])
        for (block, shard), size, stop in zip(
            ends.tolist(), sizes.tolist(), stops.tolist(), strict=True
        )
    ]


class Network(NamedTuple):
    """How many blocks and shards there are; both numbers may be exceeded a little."""

    blocks: int
    shards: int
    partitions: int
    fan_bits: int

    def _bits(self, end: int) -> int:
        return pow2(max(1, (self.blocks, self.shards)[end]))

    def hops(self, target: int) -> int:
        return max(1, math.ceil(self._bits(target) / self.fan_bits))

    def _sorted(self, found: Iterable[Message], target: int, hop: int) -> pa.Table:
        """Messages bundled for their ``hop``-th journey, the first being 1.

        The bundles of the last hop are addressed to their receiver itself.
        """
        bits, source_bits = self._bits(target), self._bits(1 - target)
        last = hop == self.hops(target)
        boxes: dict[tuple[int, int], list[Message]] = {}
        for message in found:
            to = message[target]
            if not last:
                to = _slot(to, bits) >> max(0, bits - hop * self.fan_bits)
            group = _slot(message[1 - target], source_bits) >> min(source_bits, hop * self.fan_bits)
            boxes.setdefault((group, to), []).append(message)
        rows = []
        for (group, to), box in sorted(boxes.items()):
            address = (to, group) if target == BLOCK else (group, to)
            rows.append((*address, bundled(sorted(box, key=lambda m: m[:2]))))
        return messages(rows)

    def outbox(self, function: Function, target: int) -> Function:
        """``function``, whose messages are packed for their way."""
        if self.hops(target) == 1:
            return function
        return lambda *tables: self._sorted(read_messages(function(*tables)), target, 1)

    def inbox(self, table: pa.Table, target: int) -> pa.Table:
        """The messages that arrived for one receiver."""
        if self.hops(target) == 1:
            return table
        return messages([m for payload in table["payload"].to_pylist() for m in opened(payload)])

    def relayed(self, sent: DataFrame, target: int) -> DataFrame:
        """What ``outbox`` packed, brought to the receivers."""
        for hop in range(2, self.hops(target) + 1):
            nodes = self._spread(sent, *_NAMES).groupBy(*_NAMES)
            sent = nodes.applyInArrow(self._relay(target, hop), MESSAGE)
        return self._spread(sent, _NAMES[target])

    def _relay(self, target: int, hop: int) -> Function:
        def relay(table: pa.Table) -> pa.Table:
            found = (m for payload in table["payload"].to_pylist() for m in opened(payload))
            return self._sorted(found, target, hop)

        return relay

    def _spread(self, sent: DataFrame, *keys: str) -> DataFrame:
        """Partitions by size, where the session's number would make them too large."""
        usual = int(sent.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        if self.partitions <= usual:
            return sent
        return sent.repartition(self.partitions, *keys)

    def from_blocks(self, texts: DataFrame, function: Function) -> DataFrame:
        """Messages of every block of texts, at the shards."""
        send = self.outbox(function, SHARD)
        return self.relayed(texts.groupBy("block").applyInArrow(lambda t: send(t), MESSAGE), SHARD)

    def at_shards(self, arrived: DataFrame, function: Function) -> DataFrame:
        """What every shard answers, at the blocks."""
        send = self.outbox(lambda t: function(self.inbox(t, SHARD)), BLOCK)
        return self.relayed(arrived.groupBy("shard").applyInArrow(lambda t: send(t), MESSAGE), BLOCK)

    def at_blocks(self, arrived: DataFrame, function: Function) -> DataFrame:
        """What every block makes of its answers alone, at the shards."""
        send = self.outbox(lambda t: function(self.inbox(t, BLOCK)), SHARD)
        return self.relayed(arrived.groupBy("block").applyInArrow(lambda t: send(t), MESSAGE), SHARD)

    def by_block(
        self, texts: DataFrame, arrived: DataFrame, function: Function, schema=None
    ) -> DataFrame:
        """``function(texts, answers)`` of every block that has texts.

        Its rows, or, without a ``schema``, its messages at the shards.
        """

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            return function(left, self.inbox(right, BLOCK))

        if schema is None:
            send = self.outbox(run, SHARD)
            both = texts.groupBy("block").cogroup(arrived.groupBy("block"))
            return self.relayed(both.applyInArrow(lambda t, a: send(t, a), MESSAGE), SHARD)
        both = texts.groupBy("block").cogroup(arrived.groupBy("block"))
        return both.applyInArrow(lambda t, a: run(t, a), schema)


def network(size: int, shards: int) -> Network:
    """The network of a corpus of ``size`` bytes."""
    return Network(n_blocks(size), shards, -(-size // SHUFFLE_BYTES), FAN_BITS)
