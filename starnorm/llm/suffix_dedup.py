"""Remove byte strings that occur more than once, with run-length suffix indexes.

A repeated string of 200 bytes must meet its copies in one index. Each 200-byte window
picks an anchor, the 40-byte gram of least hash in it, which depends on the window's
bytes alone; neighbouring windows share anchors and form a region. Blocks of texts
count anchors in a merged sketch; only regions whose anchor may occur twice are sent,
dealt out by the anchor. There a run-compressed Burrows-Wheeler transform is built over
the regions of some anchors at a time, and its matching statistics mark long matches.

Regions with equal bytes are sent once by a block, and enter an index twice however
many they are, as two make the match. So a group of copies costs its index two strings
and each block one message. A hot anchor, one of a passage that very many texts share,
would still gather the different surroundings of all of them. Its regions are cut down
first: a second sketch, of whole windows, tells which of their windows may occur twice,
and only those go on, which leaves the passage itself. Nothing is sampled or dropped:
every window is in exactly one region, and every copy of a region gets its marks.

Null texts count as empty. Each input row gives one output row; equal rows are copies
of each other. Columns other than id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starnorm.llm.blocks import (
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
from starnorm.llm.routes import network
from starnorm.llm.run_index import RunIndex
from starnorm.llm.sketch import Sketch, merged
from starnorm.llm.spans import (
    SEEDS,
    covered,
    group_starts,
    hash_spans,
    mixed,
    per_row,
    ranges,
    row_slices,
    runs,
    strided,
    text_bytes,
    windows_inside,
)

MATCH = 200
GRAM = 40
# Text whose windows are looked at together, and text indexed together.
SLICE_BYTES = 1 << 18
INDEX_BYTES = 60_000
# Bytes of regions that one shard holds, about.
SHARD_BYTES = 12 << 20

# An anchor is hot from two to this power occurrences on.
HOT_LEVEL = 8
# Counters of the sketch of hot anchors' windows, per window: a chance pass is rare.
WINDOW_SPARE = 1 << 14

# Messages are numbered by what they are: regions by their shard from 0 on, parts of the
# window sketch from _SKETCH on, and what a block keeps for itself from _KEPT on.
_SKETCH = 1 << 28
_KEPT = 1 << 29
_HOT, _MARKS, _SEGMENTS = b"h", b"m", b"s"

SCHEMA = (
    "id long, n_bytes long, n_removed long, n_spans long, kept binary, "
    "removed array<struct<start: long, end: long>>"
)
_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values."""
    n = values.size
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    square = padded.reshape(-1, width)
    up = np.minimum.accumulate(square, axis=1).ravel()
    down = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(down[: n - width + 1], up[width - 1 : n])


def _regions(data: np.ndarray, offsets: np.ndarray, match: int, gram: int):
    """(first byte, end, anchor hash) of each run of windows with the same anchor."""
    windows = windows_inside(offsets, match)
    if not windows.size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    eight = strided(data)
    n = data.size - gram + 1
    h = np.full(n, SEEDS[0], np.uint64)
    for at in [*range(0, gram - 7, 8), gram - 8]:
        h *= np.uint64(0x2545F4914F6CDD1D)
        h += eight[at : at + n]
        h ^= h >> np.uint64(29)
    mixed(h)
    bits = np.uint64(pow2(n + 1))
    placed = (h >> bits << bits) | np.arange(n, dtype=np.uint64)
    least = _sliding_least(placed, match - gram + 1)[windows]
    anchor = (least & np.uint64((1 << int(bits)) - 1)).astype(np.int64)
    new = np.ones(windows.size, bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (windows[1:] != windows[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], windows.size) - 1
    # Least hashes are small numbers; mixed once more they spread over all shards.
    return windows[first], windows[last] + match, mixed(h[anchor[first]] + np.uint64(SEEDS[1]))


class _Block:
    """The regions of a block, grouped into classes of equal anchor and bytes."""

    def __init__(self, table: pa.Table, match: int, gram: int):
        self.table = in_order(table)
        self.data, self.offsets = text_bytes(self.table["text"])
        parts = []
        for lo, hi in row_slices(self.offsets, SLICE_BYTES):
            begin = self.offsets[lo]
            own = self.offsets[lo : hi + 1] - begin
            first, end, anchor = _regions(self.data[begin : self.offsets[hi]], own, match, gram)
            parts.append((first + begin, end + begin, anchor))
        empty = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))
        first, end, anchor = (np.concatenate(c) for c in zip(empty, *parts, strict=True))
        content = hash_spans(self.data, first, end, loop_bytes=2 * match)[0]
        order = np.lexsort((first, content, anchor))
        self.first, self.end, self.anchor = first[order], end[order], anchor[order]
        content = content[order]
        new = np.ones(order.size, bool)
        new[1:] = (self.anchor[1:] != self.anchor[:-1]) | (content[1:] != content[:-1])
        self.leader = np.flatnonzero(new)  # first region of each class
        self.copies = np.diff(np.append(self.leader, order.size))

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct anchors, how many regions have each, and the anchor of each class."""
        first = group_starts(self.anchor)
        which = np.searchsorted(first, self.leader, side="right") - 1
        return self.anchor[first], np.diff(np.append(first, self.anchor.size)), which


def _region_payload(numbers, limit, anchor, length, several, raw) -> bytes:
    return (
        pack_sorted(numbers, limit)
        + anchor.tobytes()
        + length.astype(np.uint16).tobytes()
        + several.astype(bool).tobytes()
        + raw.tobytes()
    )


def _read_regions(payload: bytes, at: int = 0):
    numbers, at = unpack_sorted(payload, at)
    n = numbers.size
    anchor = np.frombuffer(payload, np.uint64, n, at)
    length = np.frombuffer(payload, np.uint16, n, at + 8 * n).astype(np.int64)
    several = np.frombuffer(payload, np.bool_, n, at + 10 * n)
    raw = np.frombuffer(payload, np.uint8, offset=at + 11 * n)
    return numbers.astype(np.int64), anchor, length, several, raw


def _marks_payload(numbers, limit, first, end) -> bytes:
    first, end = first.astype(np.uint16), end.astype(np.uint16)
    return pack_sorted(numbers, limit) + first.tobytes() + end.tobytes()


def _read_marks(payload: bytes, at: int = 0):
    numbers, at = unpack_sorted(payload, at)
    n = numbers.size
    first = np.frombuffer(payload, np.uint16, n, at).astype(np.int64)
    return numbers.astype(np.int64), first, np.frombuffer(payload, np.uint16, n, at + 2 * n).astype(np.int64)


def _window_keys(raw: np.ndarray, bounds: np.ndarray, match: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of all windows of strings laid end to end, and a hash of each window."""
    places = windows_inside(bounds, match)
    h, size = mixed(strided(raw)[: raw.size].copy()), 8
    while size < match:
        step = min(size, match - size)
        longer = h * np.uint64(SEEDS[0])
        longer[: h.size - step] += h[step:]
        longer ^= longer >> np.uint64(31)
        h, size = longer * np.uint64(0x2545F4914F6CDD1D), size + step
    return places, mixed(h[places])


def _marked(table: pa.Table, match: int) -> pa.Table:
    """Index the regions sent to a shard; answer with the covered parts of each."""
    found = read_messages(table)
    parts = [(np.full(p[0].size, k), *p) for k, p in enumerate(_read_regions(m[2]) for m in found)]
    message, own, anchor, length, several, raw = (np.concatenate(c) for c in zip(*parts, strict=True))
    start = np.cumsum(length) - length
    content = hash_spans(raw, start, start + length, loop_bytes=2 * match)[0]
    order = np.lexsort((content, anchor))
    anchor, content = anchor[order], content[order]
    new = np.ones(order.size, bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (content[1:] != content[:-1])
    leader = np.flatnonzero(new)
    members = np.diff(np.append(leader, order.size))
    doubled = (np.add.reduceat(several[order].astype(np.int64), leader) > 0) | (members > 1)
    # Anchors whose regions are one string in one copy can match nothing.
    group = group_starts(anchor[leader])
    strings = np.add.reduceat(1 + doubled, group)
    alive = np.repeat(strings > 1, np.diff(np.append(group, leader.size)))
    string, first, end = _index_groups(
        raw, start[order[leader]], length[order[leader]], doubled, anchor[leader], alive, match
    )
    # Marks of a string go to every block that sent it.
    size = members[string]
    member = order[ranges(leader[string], size)]
    first, end = np.repeat(first, size), np.repeat(end, size)
    back = np.lexsort((first, own[member], message[member]))
    member, first, end = member[back], first[back], end[back]
    limits = np.searchsorted(message[member], np.arange(len(found) + 1))
    answers = []
    for k, (block, shard, payload) in enumerate(found):
        lo, hi = limits[k], limits[k + 1]
        if hi > lo:
            limit = int(np.frombuffer(payload, np.int64, 2)[1])
            body = _marks_payload(own[member[lo:hi]], limit, first[lo:hi], end[lo:hi])
            answers.append((block, shard, body))
    return messages(answers)


def _index_groups(raw, start, length, doubled, anchor, alive, match):
    """(string, first, end) of covered parts, from indexes over whole anchor groups."""
    chosen = np.flatnonzero(alive)
    size = (length + 1) * (1 + doubled)
    out = [(np.zeros(0, np.int64),) * 3]
    at = 0
    limits = np.append(group_starts(anchor[chosen]), chosen.size)
    total = np.append(0, np.cumsum(size[chosen]))
    while at < chosen.size:
        fits = np.searchsorted(total[limits], total[at] + INDEX_BYTES, side="right") - 1
        nxt = int(limits[max(fits, np.searchsorted(limits, at, side="right"))])
        strings = np.repeat(chosen[at:nxt], 1 + doubled[chosen[at:nxt]])
        own = length[strings] + 1
        ends = np.cumsum(own) - 1
        begins = ends - length[strings]
        text = np.zeros(int(own.sum()), np.uint8)
        inside = np.ones(text.size, bool)
        inside[ends] = False
        text[inside] = raw[ranges(start[strings], length[strings])]
        marked = RunIndex(text, ends).long_matches(match)
        first, last, index = runs(marked, np.append(begins, text.size))
        owner = np.repeat(np.arange(strings.size), np.diff(index))
        out.append((strings[owner], first - begins[owner], last - begins[owner]))
        at = nxt
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _hot_windows(payload: bytes, at: int, match: int):
    """Distinct window hashes of a block's hot regions, their counts, and each window's place."""
    _, _, length, several, raw = _read_regions(payload, at)
    bounds = np.concatenate([[0], np.cumsum(length)])
    places, keys = _window_keys(raw, bounds, match)
    weight = 1 + np.repeat(several.astype(np.int64), length - match + 1)
    order = np.argsort(keys, kind="stable")
    first = group_starts(keys[order])
    spread = np.empty(keys.size, np.int64)
    spread[order] = np.repeat(np.arange(first.size), np.diff(np.append(first, keys.size)))
    return keys[order][first], np.add.reduceat(weight[order], first), spread


def _segments(payload: bytes, at: int, alive: np.ndarray, match: int):
    """What is left of hot regions: runs of alive windows, equal ones once.

    Numbers, anchors, lengths, whether there are several, and bytes of the distinct
    segments by (anchor, bytes); and where each segment is, for ``_of_regions``.
    """
    numbers, anchor, length, several, raw = _read_regions(payload, at)
    windows = np.concatenate([[0], np.cumsum(length - match + 1)])
    first, last, index = runs(alive, windows)
    if not first.size:
        return None
    region = np.repeat(np.arange(numbers.size), np.diff(index))
    offset = first - windows[region]
    size = last - first + match - 1
    start = (np.cumsum(length) - length)[region] + offset
    content = hash_spans(raw, start, start + size, loop_bytes=2 * match)[0]
    order = np.lexsort((region, content, anchor[region]))
    of_anchor, content = anchor[region][order], content[order]
    new = np.ones(order.size, bool)
    new[1:] = (of_anchor[1:] != of_anchor[:-1]) | (content[1:] != content[:-1])
    leader = np.flatnonzero(new)
    copies = np.diff(np.append(leader, order.size))
    many = (copies > 1) | (np.add.reduceat(several[region][order].astype(np.int64), leader) > 0)
    one = order[leader]
    number = np.repeat(np.arange(leader.size), copies)
    mapping = (
        np.array([order.size], np.int64).tobytes()
        + number.astype(np.int64).tobytes()
        + numbers[region[order]].tobytes()
        + offset[order].astype(np.int64).tobytes()
    )
    return (
        np.arange(leader.size),
        of_anchor[leader],
        size[one],
        many,
        raw[ranges(start[one], size[one])],
        mapping,
    )


def _of_regions(of_segments, mapping: bytes):
    """Marks of distinct segments as marks of the region classes they were cut from."""
    n = int(np.frombuffer(mapping, np.int64, 1, 1)[0])
    number, classes, offset = np.frombuffer(mapping, np.int64, 3 * n, 9).reshape(3, n)
    segment, first, end = (np.concatenate(c) for c in zip(*of_segments, strict=True))
    lo = np.searchsorted(number, segment)
    copies = np.searchsorted(number, segment, side="right") - lo
    place = ranges(lo, copies)
    shift = offset[place]
    return classes[place], np.repeat(first, copies) + shift, np.repeat(end, copies) + shift


def remove_repeated_bytes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    match: int = MATCH,
    gram: int = GRAM,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Per row: id, bytes, bytes removed, removed runs and their number, and what is kept.

    A byte goes if a string of ``match`` bytes that covers it starts anywhere else too.
    ``kept`` is bytes: a removed string may begin or end inside a character. Columns
    named in ``carry`` come along in a struct ``row``, with what is ``readable`` of the
    kept bytes: all but cut characters.
    """
    if not 8 <= gram <= match < 2**15:
        raise ValueError("a gram has 8 bytes at least and fits into a match")
    _, size = text_size(docs, text)
    texts = blocked(docs, id_col, text, size, carry)
    # Two anchors for each run of match - gram + 1 windows, on average.
    sketch = Sketch(2 * size // (match - gram + 2), 1, 16)
    window_sketch = Sketch(size // 8, 1, WINDOW_SPARE, _SKETCH)
    shard_bits = pow2(-(-max(1, size) // SHARD_BYTES))

    def counted(table: pa.Table) -> pa.Table:
        block = table["block"][0].as_py()
        anchors, counts, _ = _Block(table, match, gram).anchors()
        return messages(list(sketch.parts(anchors, counts, block)))

    def sent(table: pa.Table, answers: pa.Table) -> pa.Table:
        """Regions to their shards; of hot anchors, windows to the sketch and the rest kept."""
        if not table.num_rows:
            return messages([])
        block = table["block"][0].as_py()
        own = _Block(table, match, gram)
        anchors, _, which = own.anchors()
        level = sketch.read(anchors, answers, levels=True)[which]
        out = []

        def payload(numbers: np.ndarray) -> bytes:
            leader = own.leader[numbers]
            length = own.end[leader] - own.first[leader]
            raw = own.data[ranges(own.first[leader], length)]
            several = own.copies[numbers] > 1
            return _region_payload(
                numbers, own.leader.size, own.anchor[leader], length, several, raw
            )

        warm = np.flatnonzero((level > 0) & (level < HOT_LEVEL))
        for shard, lo, hi in shard_slices(own.anchor[own.leader[warm]], shard_bits):
            out.append((block, shard, payload(warm[lo:hi])))
        hot = np.flatnonzero(level >= HOT_LEVEL)
        if hot.size:
            kept = payload(hot)
            out.append((block, _KEPT + block, _HOT + kept))
            keys, counts, _ = _hot_windows(kept, 0, match)
            out += window_sketch.parts(keys, counts, block)
        return messages(out)

    def answered(table: pa.Table) -> pa.Table:
        shard = table["shard"][0].as_py()
        if shard >= _KEPT:
            return messages(read_messages(table))
        return merged(table, levels=False) if shard >= _SKETCH else _marked(table, match)

    def cut_down(table: pa.Table) -> pa.Table:
        """Keep marks for later; send what hot regions have of windows that may repeat."""
        block, out, kept = table["block"][0].as_py(), [], None
        for _, shard, payload in read_messages(table):
            if shard < _SKETCH:
                out.append((block, _KEPT + block, _MARKS + payload))
            elif shard >= _KEPT:
                kept = payload
        if kept is None:
            return messages(out)
        keys, _, spread = _hot_windows(kept, 1, match)
        own = table.filter(pc.field("shard") < _KEPT).filter(pc.field("shard") >= _SKETCH)
        alive = window_sketch.read(keys, own, levels=False)[spread]
        segments = _segments(kept, 1, alive, match)
        if segments is None:
            return messages(out)
        numbers, anchor, length, several, raw, mapping = segments
        start = np.cumsum(length) - length
        for shard, lo, hi in shard_slices(anchor, shard_bits):
            part = raw[start[lo] : start[hi - 1] + length[hi - 1]]
            body = _region_payload(
                numbers[lo:hi], numbers.size, anchor[lo:hi], length[lo:hi], several[lo:hi], part
            )
            out.append((block, shard, body))
        out.append((block, _KEPT + block, _SEGMENTS + mapping))
        return messages(out)

    def marked_again(table: pa.Table) -> pa.Table:
        if table["shard"][0].as_py() >= _KEPT:
            return messages(read_messages(table))
        return _marked(table, match)

    def cleaned(table: pa.Table, answers: pa.Table) -> pa.Table:
        own = _Block(table, match, gram)
        marks, of_segments, mapping = [], [], None
        for _, shard, payload in read_messages(answers):
            if shard < _KEPT:
                of_segments.append(_read_marks(payload))
            elif payload[:1] == _MARKS:
                marks.append(_read_marks(payload, 1))
            else:
                mapping = payload
        if of_segments:
            marks.append(_of_regions(of_segments, mapping))
        firsts, ends = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for classes, mark_first, mark_end in marks:
            copies = own.copies[classes]
            region = own.first[ranges(own.leader[classes], copies)]
            firsts.append(region + np.repeat(mark_first, copies))
            ends.append(region + np.repeat(mark_end, copies))
        removed = covered(np.concatenate(firsts), np.concatenate(ends), own.data.size)
        first, last, index = runs(removed, own.offsets)
        row_first = np.repeat(own.offsets[:-1], np.diff(index))
        spans = pa.StructArray.from_arrays(
            [pa.array(first - row_first), pa.array(last - row_first)], fields=list(_SPAN)
        )
        n_removed = per_row(removed, own.offsets)
        n_bytes = np.diff(own.offsets)
        kept = np.concatenate([[0], np.cumsum(n_bytes - n_removed)]).astype(np.int32)
        raw = own.data[~removed].tobytes()
        out = pa.table(
            {
                "id": own.table["id"],
                "n_bytes": n_bytes,
                "n_removed": n_removed,
                "n_spans": np.diff(index),
                "kept": pa.Array.from_buffers(
                    pa.binary(), n_bytes.size, [None, pa.py_buffer(kept), pa.py_buffer(raw)]
                ),
                "removed": pa.ListArray.from_arrays(pa.array(index, pa.int32()), spans),
            }
        )
        if not carry:
            return out
        readable = [raw[a:b].decode("utf-8", "ignore") for a, b in zip(kept, kept[1:], strict=False)]
        return out.append_column("readable", pa.array(readable, pa.string())).append_column(
            "row", own.table["row"]
        )

    schema = SCHEMA
    if carry:
        added = [T.StructField("readable", T.StringType()), texts.schema["row"]]
        schema = T.StructType([*_parsed(docs, SCHEMA), *added])
    shards = max(sketch.shards, window_sketch.shards, 1 << shard_bits)
    route = network(size, shards)
    counts = route.from_blocks(texts, counted)
    levels = route.at_shards(counts, lambda t: merged(t, levels=True))
    regions = route.by_block(texts, levels, sent)
    answers = route.at_shards(regions, answered)
    segments = route.at_blocks(answers, cut_down)
    marks = route.at_shards(segments, marked_again)
    return route.by_block(texts, marks, cleaned, schema)


def _parsed(docs: DataFrame, ddl: str) -> T.StructType:
    return docs.sparkSession.createDataFrame([], ddl).schema


def without_repeated_bytes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    match: int = MATCH,
    length: str | None = "n_chars",
) -> DataFrame:
    """The rows of ``docs``, all columns, with what is kept of each text.

    A character cut by a removal goes whole. Rows of whose text nothing is kept go.
    ``length`` names the column, if there is one, that has the characters of the text.
    """
    cleaned = remove_repeated_bytes(docs, id_col, text, match, carry=docs.columns)
    kept = cleaned.where("readable <> ''")
    types = docs.schema
    renewed = {text: F.col("readable")}
    if length in docs.columns:
        renewed[length] = F.length("readable").cast(types[length].dataType)
    return kept.select(
        *[renewed.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns]
    )
