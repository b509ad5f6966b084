"""Messages by relays: each arrives once, and there are not many of them."""

import random

import pytest
from pyspark.sql import functions as F

from starnorm.llm import blocks, routes
from starnorm.llm.routes import BLOCK, SHARD, Network, bundled, opened


def test_bundles_open_again():
    found = [(3, 1 << 30, b"abc"), (0, 7, b""), (-1, 2, b"\0" * 5)]
    assert opened(bundled(found)) == found
    assert opened(bundled([])) == []


def every_block(size, blocks_, shards):
    """Each block sends a message to each shard."""

    def send(table):
        block = table["block"][0].as_py()
        return blocks.messages([(block, shard, b"%d>%d" % (block, shard)) for shard in range(shards)])

    return send


@pytest.mark.parametrize("fan_bits", [1, 2, 3, 10])
@pytest.mark.parametrize("n_blocks, n_shards", [(13, 30), (30, 5), (1, 1)])
def test_every_message_arrives_and_is_answered(spark, fan_bits, n_blocks, n_shards):
    route = Network(n_blocks, n_shards, 1, fan_bits)
    texts = spark.range(n_blocks * 3).select((F.col("id") % n_blocks).cast("int").alias("block"))

    def answer(table):
        found = blocks.read_messages(table)
        assert [m[0] for m in found] == list(range(n_blocks))
        assert len({m[1] for m in found}) == 1
        return blocks.messages([(b, s, p + b"!") for b, s, p in found])

    def again(table):
        return blocks.messages([(b, s, p + b"?") for b, s, p in blocks.read_messages(table)])

    def last(left, right):
        found = blocks.read_messages(right)
        block = left["block"][0].as_py()
        assert {m[0] for m in found} == {block}
        import pyarrow as pa

        return pa.table({"block": pa.array([block], pa.int32()), "got": [b"|".join(sorted(m[2] for m in found))]})

    sent = route.from_blocks(texts, every_block(0, n_blocks, n_shards))
    answers = route.at_shards(sent, answer)
    sent = route.at_blocks(answers, again)
    answers = route.at_shards(sent, answer)
    got = route.by_block(texts, answers, last, "block int, got binary").collect()
    for row in got:
        words = sorted(b"%d>%d!?!" % (row.block, shard) for shard in range(n_shards))
        assert bytes(row.got) == b"|".join(words)
    assert len(got) == n_blocks


def test_bundles_grow_in_proportion():
    """Twice the blocks and twice the shards make about twice the bundles in every hop."""

    def bundles(n):
        route = Network(n, n, 1, 3)
        nodes = {(b, 0): [(b, s, b"x") for s in range(n)] for b in range(n)}
        counts = []
        for hop in range(1, route.hops(SHARD) + 1):
            boxes = {}
            for found in nodes.values():
                for block, shard, payload in blocks.read_messages(route._sorted(found, SHARD, hop)):
                    boxes.setdefault((block, shard), []).append(payload)
            counts.append(sum(map(len, boxes.values())))
            nodes = {k: [m for p in v for m in opened(p)] for k, v in boxes.items()}
        arrived = sorted(m[:2] for found in nodes.values() for m in found)
        assert arrived == [(b, s) for b in range(n) for s in range(n)]
        return counts

    sizes = [64, 128, 256, 512]
    most = [max(bundles(n)) / n for n in sizes]
    assert all(per_block <= 2 * 8 for per_block in most)  # straight: 64, 128, 256, 512


def test_straight_where_receivers_are_few():
    route = routes.network(512 << 20, 128)
    assert route.hops(SHARD) == route.hops(BLOCK) == 1
    assert routes.network(1 << 40, 1 << 18).hops(SHARD) == 2
    assert routes.network(100 << 40, 25 << 20).hops(SHARD) == 3
