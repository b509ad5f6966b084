"""Language-model scores by context-tree weighting, and a word-unigram base.

The model predicts the bytes of a text's tokens: its words, A-Z lower-cased, with one
space between them and a line feed as the end, each byte from the five before it.
Blocks send their distinct grams with training counts to shards that own the grams'
two nearest context bytes; a shard holds all deeper nodes of its contexts. What the
trees have above that, 256 contexts of one byte and the empty one, is summed from all
shards in two small steps and sent back. Shards then answer each block with the log
probability of every gram it has. Words go the same way for the base.

Texts are learned from if crc32 of the id, as text, modulo 5 is not 1; a null id counts
as an empty text. Null texts count as empty: the end alone is scored. Each input row
gives one output row; columns other than id and text are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starnorm.llm.blocks import (
    MESSAGE,
    blocked,
    in_order,
    messages,
    pack_sorted,
    pow2,
    read_messages,
    shard_slices,
    text_size,
    unpack_sorted,
)
from starnorm.llm.context_tree import DEPTH, Forest, mixture, weighted
from starnorm.llm.routes import BLOCK, SHARD, Network, network
from starnorm.llm.spans import (
    LOWER,
    group_starts,
    hash_spans,
    mixed,
    per_row,
    ranges,
    row_slices,
    text_bytes,
    word_spans,
)

FOLDS, HELD_OUT = 5, 1
END = 10
SLICE_BYTES = 2 << 20
# Text behind each shard of grams, and of words.
SHARD_BYTES = 16 << 20
# Lots of shards whose sums are added up before all are.
LOTS = 256

_WORD_SHARDS = 1 << 30  # shards of words are numbered from here
_HASH_BITS = 62
_END_HASH = np.uint64(1)
_GRAM_BITS = 8 * (DEPTH + 1)

SCHEMA = (
    "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
    "base_score double, score double, n_scored_bytes long"
)


def held_out(i: int | None) -> bool:
    return zlib.crc32(b"" if i is None else str(i).encode()) % FOLDS == HELD_OUT


def token_bytes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray):
    """The bytes to predict, each text after ``DEPTH`` ends, and each text's first place."""
    n_words = np.diff(bounds)
    length = ends - starts + 1
    total = np.concatenate([[0], np.cumsum(length)])
    own = total[bounds[1:]] - total[bounds[:-1]] + (n_words == 0)
    begin = np.cumsum(own + DEPTH) - own
    out = np.full(int((own + DEPTH).sum()), END, np.uint8)
    row = np.repeat(np.arange(n_words.size), n_words)
    to = begin[row] + total[:-1] - total[bounds[:-1]][row]
    out[to + length - 1] = 32
    last = n_words > 0
    out[(begin + own - 1)[last]] = END
    out[ranges(to, length - 1)] = data[ranges(starts, length - 1)]
    return out, begin, own


def _grams(text: np.ndarray, begin: np.ndarray, own: np.ndarray) -> np.ndarray:
    """The gram of each predicted byte, text after text."""
    wide = text.astype(np.uint64)
    n = wide.size - DEPTH
    all_grams = wide[DEPTH:].copy()
    for back in range(1, DEPTH + 1):
        all_grams |= wide[DEPTH - back : DEPTH - back + n] << np.uint64(8 * (DEPTH + 1 - back))
    return all_grams[ranges(begin - DEPTH, own)]


def _slices(data: np.ndarray, offsets: np.ndarray, words):
    """(first row, next row, grams, predicted bytes per row) of a block's row ranges."""
    starts, ends, bounds = words
    for lo, hi in row_slices(offsets, SLICE_BYTES):
        for a in range(lo, hi, 1 << 16):
            b = min(hi, a + (1 << 16))
            w = slice(bounds[a], bounds[b])
            text, begin, own = token_bytes(
                data, starts[w], ends[w], bounds[a : b + 1] - bounds[a]
            )
            yield a, b, _grams(text, begin, own), own


class _Block:
    def __init__(self, table: pa.Table):
        self.table = in_order(table)
        data, self.offsets = text_bytes(self.table["text"])
        self.data = LOWER[data]
        self.words = word_spans(self.data, self.offsets)
        self.bounds = self.words[2]
        self.held_out = np.array([held_out(i) for i in self.table["id"].to_pylist()], bool)

    def word_hashes(self) -> np.ndarray:
        starts, ends, _ = self.words
        h = hash_spans(self.data, starts, ends)[0] >> np.uint64(64 - _HASH_BITS)
        return np.maximum(h, _END_HASH + np.uint64(1))

    def grams(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct grams, sorted, with their counts in texts that are learned from."""
        parts, counts = [], []
        for a, b, grams, own in _slices(self.data, self.offsets, self.words):
            learned = np.repeat(~self.held_out[a:b], own)
            for part, weight in ((grams[learned], 1), (grams[~learned], 0)):
                part = np.sort(part)
                first = group_starts(part)
                parts.append(part[first])
                counts.append(weight * np.diff(np.append(first, part.size)))
        return _summed(np.concatenate(parts), np.concatenate(counts))


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    first = group_starts(keys[order])
    if not first.size:
        return keys, counts
    return keys[order][first], np.add.reduceat(counts[order], first)


def _pack_counts(counts: np.ndarray) -> bytes:
    """Counts in a byte each, and what is 255 or more once again in eight."""
    large = counts[counts >= 255]
    return np.minimum(counts, 255).astype(np.uint8).tobytes() + large.astype(np.int64).tobytes()


def _unpack_counts(payload: bytes, size: int, at: int) -> np.ndarray:
    counts = np.frombuffer(payload, np.uint8, size, at).astype(np.int64)
    large = counts == 255
    counts[large] = np.frombuffer(payload, np.int64, np.count_nonzero(large), at + size)
    return counts


def _gram_shards(grams: np.ndarray, bits: int) -> np.ndarray:
    contexts = mixed(grams >> np.uint64(8 * (DEPTH - 1)))
    return (contexts >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(grams.size, int)


def _sent(table: pa.Table, bits: int) -> pa.Table:
    """Messages with a block's distinct grams and words and their training counts."""
    block, own, out = table["block"][0].as_py(), _Block(table), []
    grams, counts = own.grams()
    shards = _gram_shards(grams, bits)
    order = np.argsort(shards, kind="stable")
    cut = group_starts(shards[order])
    for lo, hi in zip(cut, np.append(cut[1:], shards.size), strict=True):
        part = order[lo:hi]
        payload = pack_sorted(grams[part], 1 << _GRAM_BITS) + _pack_counts(counts[part])
        out.append((block, int(shards[part[0]]), payload))
    words = own.word_hashes()
    learned = np.repeat(~own.held_out, np.diff(own.bounds))
    learned_texts = int(np.count_nonzero(~own.held_out))
    words, counts = _summed(
        np.append(words, _END_HASH), np.append(learned.astype(np.int64), learned_texts)
    )
    for shard, lo, hi in shard_slices(words << np.uint64(64 - _HASH_BITS), bits):
        payload = pack_sorted(words[lo:hi], 1 << _HASH_BITS) + _pack_counts(counts[lo:hi])
        out.append((block, _WORD_SHARDS + shard, payload))
    return messages(out)


def _read_counts(found) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """The keys of each message, and all distinct keys with their summed counts."""
    keys, counts = [], []
    for _, _, payload in found:
        own, at = unpack_sorted(payload)
        keys.append(own)
        counts.append(_unpack_counts(payload, own.size, at))
    return keys, *_summed(np.concatenate(keys), np.concatenate(counts))


_TOP = "context int, shard int, payload binary"


def _top_rows(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    contexts, shards, payloads = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.table(
        {
            "context": pa.array(contexts, pa.int32()),
            "shard": pa.array(shards, pa.int32()),
            "payload": pa.array(payloads, pa.binary()),
        }
    )


def _partial_top(table: pa.Table) -> pa.Table:
    """What a shard adds to the nodes of each one-byte context; of words, their totals."""
    shard = table["shard"][0].as_py()
    _, keys, counts = _read_counts(read_messages(table))
    learned = counts > 0
    if shard >= _WORD_SHARDS:
        totals = np.array([counts.sum(), np.count_nonzero(learned)], np.float64)
        return _top_rows([(-1, shard, totals.tobytes())])
    sums = np.zeros((256, 3, 256))
    for parent, *values in Forest(keys[learned], counts[learned]).sums():
        context, decision = (parent >> np.uint64(8)).astype(int), (parent & np.uint64(255)).astype(int)
        for k, value in enumerate(values):
            sums[context, k, decision] = value
    # Contexts without training counts are asked about, too.
    asked = np.unique((keys >> np.uint64(8 * DEPTH)).astype(np.int64)).tolist()
    return _top_rows([(context, shard, sums[context].tobytes()) for context in asked])


def _added(table: pa.Table) -> pa.Table:
    """The sums of some shards for one context, as those of one."""
    total = np.sum([np.frombuffer(p) for p in table["payload"].to_pylist()], axis=0)
    return _top_rows([(table["context"][0].as_py(), table["lot"][0].as_py(), total.tobytes())])


def _merged_top(table: pa.Table) -> pa.Table:
    """One context's nodes for the shards, and once more, as shard -1, for the empty context."""
    context = table["context"][0].as_py()
    found = sorted(
        zip(table["shard"].to_pylist(), table["payload"].to_pylist(), strict=True),
        key=lambda row: row[0],
    )
    total = np.sum([np.frombuffer(payload) for _, payload in found], axis=0)
    if context < 0:
        return _top_rows([(context, -1, total.tobytes())])
    zeros, ones, below = total.reshape(3, 256)
    log_weighted, stop = weighted(zeros.astype(np.int64), ones.astype(np.int64), below)
    nodes = np.stack([zeros, ones, stop]).tobytes()
    up = np.stack([zeros, ones, log_weighted]).tobytes()
    return _top_rows([(context, -1, up), (context, 0, nodes)])


def _empty_context(table: pa.Table) -> pa.Table:
    """The nodes without context and the word totals, for the shards."""
    rows = sorted(
        zip(table["context"].to_pylist(), table["payload"].to_pylist(), strict=True),
        key=lambda row: row[0],
    )
    totals = np.zeros(2)
    sums = np.zeros((3, 256))
    for context, payload in rows:
        if context < 0:
            totals = np.frombuffer(payload)
        else:
            sums += np.frombuffer(payload).reshape(3, 256)
    zeros, ones, below = sums
    _, stop = weighted(zeros.astype(np.int64), ones.astype(np.int64), below)
    return _top_rows([(-1, 0, np.concatenate([totals, zeros, ones, stop]).tobytes())])


def upper_nodes(arrived: DataFrame, route: Network) -> Column:
    """The nodes of all one-byte contexts and of none: at most 257 of 6 KB, whatever the input.

    Shards are added up in lots first, so that no task gathers what all of them have.
    """
    partial = arrived.groupBy("shard").applyInArrow(
        lambda t: _partial_top(route.inbox(t, SHARD)), _TOP
    )
    lot = F.pmod(F.xxhash64("shard"), F.lit(LOTS)).cast("int").alias("lot")
    lots = partial.select("context", "payload", lot).groupBy("context", "lot")
    top = lots.applyInArrow(_added, _TOP).groupBy("context").applyInArrow(_merged_top, _TOP)
    root = top.where("shard < 0").groupBy("shard").applyInArrow(_empty_context, _TOP)
    every = top.where("shard >= 0").union(root)
    return every.agg(F.collect_list(F.struct("context", "payload"))).scalar()


def _answers(table: pa.Table, top: pa.Table) -> pa.Table:
    """For each message of a shard, log10 probabilities of its grams or counts of its words."""
    if not table.num_rows:
        return messages([])
    found = read_messages(table)
    keys, distinct, counts = _read_counts(found)
    nodes = {n["context"]: n["payload"] for n in top["nodes"][0].as_py()}
    nodes = dict(sorted(nodes.items()))
    root = np.frombuffer(nodes.pop(-1))
    totals, (zeros0, ones0, stop0) = root[:2], root[2:].reshape(3, 256)
    if found[0][1] >= _WORD_SHARDS:
        return messages(
            [
                (block, shard, totals.tobytes() + _pack_counts(counts[np.searchsorted(distinct, own)]))
                for (block, shard, _), own in zip(found, keys, strict=True)
            ]
        )
    place = np.zeros(256, np.int64)
    for k, context in enumerate(nodes):
        place[context] = k
    zeros1, ones1, stop1 = np.stack(
        [np.frombuffer(p).reshape(3, 256) for p in nodes.values()], axis=1
    )
    near = place[(distinct >> np.uint64(8 * DEPTH)).astype(np.int64)]

    def upper(decision, one, p):
        at = near, decision
        p = mixture(zeros1[at], ones1[at], stop1[at], one, p)
        return mixture(zeros0[decision], ones0[decision], stop0[decision], one, p)

    learned = counts > 0
    scores = Forest(distinct[learned], counts[learned]).log10(distinct, upper).astype(np.float32)
    return messages(
        [
            (block, shard, scores[np.searchsorted(distinct, own)].tobytes())
            for (block, shard, _), own in zip(found, keys, strict=True)
        ]
    )


def _scored(table: pa.Table, answers: pa.Table, bits: int) -> pa.Table:
    own = _Block(table)
    found = {shard: payload for _, shard, payload in read_messages(answers)}
    rows = own.table.num_rows
    grams, _ = own.grams()
    shards = _gram_shards(grams, bits)
    log10 = np.empty(grams.size, np.float32)
    order = np.argsort(shards, kind="stable")
    cut = group_starts(shards[order])
    for lo, hi in zip(cut, np.append(cut[1:], shards.size), strict=True):
        part = order[lo:hi]
        log10[part] = np.frombuffer(found[int(shards[part[0]])], np.float32)
    score, n_bytes = np.zeros(rows), np.zeros(rows, np.int64)
    for a, b, part, length in _slices(own.data, own.offsets, own.words):
        # A gram takes 48 bits and a row of the slice the other 16.
        row = np.repeat(np.arange(b - a, dtype=np.uint64), length)
        both = np.sort(part << np.uint64(64 - _GRAM_BITS) | row)
        gram = both >> np.uint64(64 - _GRAM_BITS)
        first = group_starts(gram)
        value = log10[np.searchsorted(grams, gram[first])].astype(np.float64)
        value = np.repeat(value, np.diff(np.append(first, gram.size)))
        row = (both & np.uint64((1 << (64 - _GRAM_BITS)) - 1)).astype(np.int64)
        score[a:b] = np.bincount(row, value, minlength=b - a)
        n_bytes[a:b] = length
    words = own.word_hashes()
    every, which = _summed_index(np.append(words, _END_HASH))
    count = np.empty(every.size, np.int64)
    totals = np.zeros(2)
    for shard, lo, hi in shard_slices(every << np.uint64(64 - _HASH_BITS), bits):
        payload = found[_WORD_SHARDS + shard]
        totals = np.frombuffer(payload, np.float64, 2)
        count[lo:hi] = _unpack_counts(payload, hi - lo, 16)
    tokens, distinct = totals
    log_count = np.log10(count + 0.5)
    word_count = count[which[:-1]]
    end_count = count[which[-1]]
    n_words = np.diff(own.bounds)
    sums = np.concatenate([[0.0], np.cumsum(log_count[which[:-1]])])
    base = sums[own.bounds[1:]] - sums[own.bounds[:-1]] + np.log10(end_count + 0.5)
    base -= (n_words + 1) * np.log10(tokens + 0.5 * (distinct + 1))
    return pa.table(
        {
            "id": own.table["id"],
            "held_out": own.held_out,
            "n_tokens": n_words + 1,
            "n_known": per_row(word_count > 0, own.bounds) + int(end_count > 0),
            "train_tokens": np.full(rows, int(tokens), np.int64),
            "base_score": base,
            "score": score,
            "n_scored_bytes": n_bytes,
        }
    )


def _summed_index(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the index of each key among them."""
    order = np.argsort(keys, kind="stable")
    first = group_starts(keys[order])
    which = np.empty(keys.size, np.int64)
    which[order] = np.repeat(np.arange(first.size), np.diff(np.append(first, keys.size)))
    return keys[order][first], which


def score_documents(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, held_out, n_tokens, n_known, train_tokens, base_score, score and bytes.

    Scores are log10 probabilities of the whole text; ``-score * log2(10) /
    n_scored_bytes`` is the code length in bits per byte.
    """
    _, size = text_size(docs, text)
    texts = blocked(docs, id_col, text, size)
    bits = pow2(-(-max(1, size) // SHARD_BYTES))
    half = 1 << bits
    route = network(size, 2 * half)
    sent = route.from_blocks(texts, lambda t: _sent(t, bits))
    number = F.col("id")
    shard = F.when(number < half, number).otherwise(number - half + _WORD_SHARDS).cast("int")
    tasks = -(-half // 32)
    upper = docs.sparkSession.range(0, 2 * half, 1, tasks).select(
        shard.alias("shard"), upper_nodes(sent, route).alias("nodes")
    )

    def answered(table: pa.Table, top: pa.Table) -> pa.Table:
        return _answers(route.inbox(table, SHARD), top)

    pack = route.outbox(answered, BLOCK)
    both = sent.groupBy("shard").cogroup(upper.groupBy("shard"))
    answers = route.relayed(both.applyInArrow(lambda t, top: pack(t, top), MESSAGE), BLOCK)
    return route.by_block(texts, answers, lambda t, a: _scored(t, a, bits), SCHEMA)
