"""Find benchmark passages in training texts with suffix arrays of the texts.

A task takes its texts a few megabytes at a time, numbers their words and builds a
suffix array over them: a shard. Every test suffix is looked up in the shard by binary
search, one word deeper at a time, until no suffix of the shard agrees any more. The
range it had at the depth of its window are all occurrences of the window; the deepest
range that was not empty is the longest verbatim match. Words that no test item has
end a match, so stretches without a whole window between two of them are not indexed.

Texts do not move: a shard is what a task holds anyway, so no key, however hot, gathers
rows, and a lost task builds its shards anew. The test items go to all tasks in chunks
of at most about ``CHUNK_BYTES``, one pass over the texts for each; longer items are
cut into pieces that overlap by a window less a word, so a match is reported as long as
it is inside a piece.

Words are runs of ASCII letters, digits and all characters beyond ASCII, A to Z lowered;
they are compared by 64-bit hashes. Null texts have no words; an item without words has
no window. Rows with equal ids are judged each by its own text; items with equal ids are
one item, and one with a null id is named by the empty string. An empty benchmark hits
nothing, an empty table gives no rows. Texts are taken whole.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starnorm.llm.blocks import quoted
from starnorm.llm.spans import (
    LOWER,
    covered,
    hash_spans,
    ranges,
    row_slices,
    runs,
    text_bytes,
    word_spans,
)
from starnorm.llm.suffix_array import SuffixArray
from starnorm.staging import staged

WINDOW = 10
# Bytes of word hashes in a chunk of the benchmark, and words in a piece of an item.
CHUNK_BYTES = 16 << 20
PIECE_WORDS = 1 << 16
# Text that is indexed together, and text whose words are hashed together.
SHARD_BYTES = 2 << 20
SLICE_BYTES = 1 << 20

# Bytes 0 to 127 but digits and lower-case letters; upper-case ones are lowered before.
BETWEEN = np.ones(256, bool)
BETWEEN[0x30:0x3A] = BETWEEN[0x61:0x7B] = BETWEEN[0x80:] = False


class Sizes(NamedTuple):
    """How much a task looks at together; results do not depend on it."""

    shard: int
    slice: int
    piece: int


def sizes() -> Sizes:
    return Sizes(SHARD_BYTES, SLICE_BYTES, PIECE_WORDS)


def word_hashes(
    data: np.ndarray, offsets: np.ndarray, size: int
) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every word, and the index of each row's first word.

    Rows longer than ``size`` are hashed a slice at a time, cut between words.
    """
    cuts = [offsets]
    for row in np.flatnonzero(np.diff(offsets) > size):
        at, end = int(offsets[row]) + size, int(offsets[row + 1])
        while at < end:
            between = np.flatnonzero(BETWEEN[LOWER[data[at : min(at + size, end)]]])
            if between.size:
                cuts.append(np.array([at + between[0]]))
            at += size
    parts = np.sort(np.concatenate(cuts), kind="stable")
    hashes, counts = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
    for lo, hi in row_slices(parts, size):
        own = parts[lo : hi + 1] - parts[lo]
        lowered = LOWER[data[parts[lo] : parts[hi]]]
        starts, ends, bounds = word_spans(lowered, own, BETWEEN)
        hashes.append(hash_spans(lowered, starts, ends)[0])
        counts.append(np.diff(bounds))
    total = np.cumsum(np.concatenate(counts))
    return np.concatenate(hashes), total[np.searchsorted(parts, offsets)]


class Benchmark(NamedTuple):
    """A chunk of test items, prepared for search; it goes to every task."""

    vocabulary: np.ndarray  # sorted hashes of all words
    words: np.ndarray  # all items end to end, words by their place in the vocabulary, from 1
    at: np.ndarray  # where each window begins
    size: np.ndarray  # words in it
    limit: np.ndarray  # words from there to the item's end
    item: np.ndarray  # the class of equal items it is in
    ids: list[list[str]]  # the ids of each class

    @property
    def depth(self) -> int:
        return int(self.limit.max(initial=0))


def prepared(items: list[tuple[str, bytes]], window: int) -> Benchmark:
    """Items, given by id and word hashes; equal ones are searched once."""
    classes: dict[bytes, list[str]] = {}
    for name, raw in items:
        classes.setdefault(raw, []).append(name)
    found = [(np.frombuffer(raw, np.uint64), sorted(set(n))) for raw, n in sorted(classes.items())]
    hashes = np.concatenate([np.zeros(0, np.uint64), *[h for h, _ in found]])
    vocabulary, words = np.unique(hashes, return_inverse=True)
    length = np.array([h.size for h, _ in found], np.int64)
    start = np.cumsum(length) - length
    size = np.minimum(length, window)
    many = np.where(length > 0, length - size + 1, 0)
    at = ranges(start, many)
    item = np.repeat(np.arange(length.size), many)
    return Benchmark(
        vocabulary,
        words.astype(np.int64) + 1,
        at,
        size[item],
        (start + length)[item] - at,
        item,
        [names for _, names in found],
    )


class Matches(NamedTuple):
    """What a shard has of the test items."""

    bounds: np.ndarray  # the index of each row's first word
    hit: np.ndarray  # for each word, whether a window covers it
    windows: list[np.ndarray]  # per row, the distinct windows in it
    classes: list[np.ndarray]  # per distinct window, the classes of items that have it
    longest: np.ndarray  # for each window's suffix, words matched
    # The ranges of such matches among ``places``, the first words of sorted suffixes.
    lo: np.ndarray
    hi: np.ndarray
    places: np.ndarray


def search(data: np.ndarray, offsets: np.ndarray, bench: Benchmark, size: Sizes) -> Matches:
    """Build the suffix array of these rows and look up all test suffixes."""
    hashes, bounds = word_hashes(data, offsets, size.slice)
    n_rows = offsets.size - 1
    none = Matches(
        bounds,
        np.zeros(hashes.size, bool),
        [np.zeros(0, np.int64)] * n_rows,
        [],
        *np.zeros((3, bench.at.size), np.int64),
        np.zeros(0, np.int64),
    )
    if not hashes.size or not bench.at.size:
        return none
    number = np.searchsorted(bench.vocabulary, hashes)
    number[number == bench.vocabulary.size] = 0
    known = bench.vocabulary[number] == hashes
    first, last, _ = runs(known, bounds)
    room = last - first >= bench.size.min()
    first, last = first[room], last[room]
    if not first.size:
        return none
    # The stretches end to end, 0 after each.
    origin = ranges(first, last - first + 1)
    words = np.where(known[np.minimum(origin, known.size - 1)], 1, 0)
    words *= number[np.minimum(origin, known.size - 1)] + 1
    words[np.cumsum(last - first + 1) - 1] = 0
    shard = SuffixArray(words, bench.depth)

    lo, hi = np.zeros(bench.at.size, np.int64), np.full(bench.at.size, words.size)
    window_lo, window_hi = np.zeros_like(lo), np.zeros_like(hi)
    longest, last_lo, last_hi = none.longest, none.lo, none.hi
    active, depth = np.arange(bench.at.size), 0
    while active.size:
        wanted = bench.words[bench.at[active] + depth]
        lo, hi = shard.narrowed(lo, hi, depth, wanted)
        some = hi > lo
        active, lo, hi, depth = active[some], lo[some], hi[some], depth + 1
        longest[active], last_lo[active], last_hi[active] = depth, lo, hi
        whole = bench.size[active] == depth
        window_lo[active[whole]], window_hi[active[whole]] = lo[whole], hi[whole]
        deeper = bench.limit[active] > depth
        active, lo, hi = active[deeper], lo[deeper], hi[deeper]

    met = np.flatnonzero(window_hi > window_lo)
    keys = np.stack([bench.size[met], window_lo[met], window_hi[met]])
    distinct, which = np.unique(keys, axis=1, return_inverse=True)
    which = which.ravel()
    by_window = np.argsort(which, kind="stable")
    limits = np.searchsorted(which[by_window], np.arange(distinct.shape[1] + 1))
    owners = bench.item[met[by_window]]
    classes = [np.unique(owners[a:b]) for a, b in zip(limits, limits[1:], strict=False)]
    window, places = shard.occurrences(distinct[1], distinct[2])
    begin = origin[places]
    hit = covered(begin, begin + distinct[0][window], hashes.size)
    row = np.searchsorted(bounds, begin, side="right") - 1
    pairs = np.unique(np.stack([row, window]), axis=1)
    limits = np.searchsorted(pairs[0], np.arange(n_rows + 1))
    windows = [pairs[1, a:b] for a, b in zip(limits, limits[1:], strict=False)]
    return Matches(
        bounds, hit, windows, classes, longest, last_lo, last_hi, origin[shard.places]
    )


_FOUND = (
    "struct<n_words: long, spans: array<struct<start: long, end: long>>, items: array<string>>"
)
_SPAN = [pa.field("start", pa.int64()), pa.field("end", pa.int64())]


def _found(texts: pa.Array, bench: Benchmark, size: Sizes) -> pa.Array:
    """Per text its words, the stretches covered by windows, and the items they are of."""
    data, offsets = text_bytes(texts)
    n_words, starts, ends, per_text = [], [], [], []
    items: list[list[str]] = []
    for a, b in row_slices(offsets, size.shard):
        own = offsets[a : b + 1] - offsets[a]
        found = search(data[offsets[a] : offsets[b]], own, bench, size)
        n_words.append(np.diff(found.bounds))
        first, last, index = runs(found.hit, found.bounds)
        row_first = np.repeat(found.bounds[:-1], np.diff(index))
        starts.append(first - row_first)
        ends.append(last - row_first)
        per_text.append(np.diff(index))
        # Copies of a text have the same windows, and so the same items.
        known: dict[bytes, list[str]] = {}
        for windows in found.windows:
            key = windows.tobytes()
            if key not in known:
                classes = {c for w in windows for c in found.classes[w].tolist()}
                known[key] = sorted({name for c in classes for name in bench.ids[c]})
            items.append(known[key])

    def joined(parts: list[np.ndarray]) -> np.ndarray:
        return np.concatenate([np.zeros(0, np.int64), *parts])

    index = np.concatenate([[0], np.cumsum(joined(per_text))])
    spans = pa.StructArray.from_arrays(
        [pa.array(joined(starts)), pa.array(joined(ends))], fields=_SPAN
    )
    return pa.StructArray.from_arrays(
        [
            pa.array(joined(n_words)),
            pa.ListArray.from_arrays(pa.array(index, pa.int32()), spans),
            pa.array(items, pa.list_(pa.string())),
        ],
        ["n_words", "spans", "items"],
    )


def _finder(shared: Broadcast, size: Sizes):
    """A function from texts to what a chunk of the benchmark has in them."""

    @F.arrow_udf(_FOUND)
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bench = shared.value
        for batch in batches:
            yield _found(batch, bench, size)

    return found


def _hashes_of(window: int, size: Sizes):
    """A function from item texts to the word hashes of their pieces."""

    @F.arrow_udf("array<binary>")
    def pieces(texts: pa.Array) -> pa.Array:
        data, offsets = text_bytes(texts)
        hashes, bounds = word_hashes(data, offsets, size.slice)
        out = []
        for a, b in zip(bounds, bounds[1:], strict=False):
            step = size.piece - window + 1
            cuts = range(int(a), max(int(b) - window + 1, int(a) + 1), step)
            out.append([hashes[c : min(c + size.piece, b)].tobytes() for c in cuts if b > a])
        return pa.array(out, pa.list_(pa.binary()))

    return pieces


def chunks(benchmark: DataFrame, item_col: str, text: str, window: int) -> Iterator[Benchmark]:
    """The benchmark, in chunks of about ``CHUNK_BYTES`` that the driver holds one at a time."""
    item = F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item")
    raw = benchmark.select(item, F.explode(_hashes_of(window, sizes())(F.col(text))).alias("raw"))
    pieces = staged(raw, "benchmark")
    size = pieces.agg(F.sum(F.octet_length("raw") + F.octet_length("item"))).first()[0] or 0
    n = max(1, -(-size // CHUNK_BYTES))
    for k in range(n):
        own = pieces.where(F.pmod(F.xxhash64("item", "raw"), F.lit(n)) == k)
        yield prepared([(r["item"], bytes(r["raw"])) for r in own.collect()], window)


def _covered_words(spans: Column) -> Column:
    """Words in any of the spans; they may overlap."""
    start = F.struct(F.lit(0).cast("long").alias("upto"), F.lit(0).cast("long").alias("total"))

    def step(seen: Column, span: Column) -> Column:
        upto = F.greatest(seen["upto"], span["end"])
        new = upto - F.greatest(seen["upto"], F.least(span["start"], upto))
        return F.struct(upto.alias("upto"), (seen["total"] + new).alias("total"))

    return F.aggregate(F.array_sort(spans), start, step, lambda seen: seen["total"])


def mark(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    carry: Sequence[str] = (),
) -> DataFrame:
    """(id, n_words, n_hit, items, spans, contaminated) per row.

    ``items`` are the ids, as sorted strings, of items with a window in the text; the
    ``spans`` of words they cover are in ``[start, end)`` and may overlap. Columns named
    in ``carry`` come along in a struct ``row``.
    """
    columns = [F.col(id_col).alias("id"), F.col(text).cast("string").alias("text")]
    if carry:
        columns.append(F.struct(*[F.col(quoted(c)).alias(c) for c in carry]).alias("row"))
    marked, names = docs.select(*columns), []
    for k, chunk in enumerate(chunks(benchmark, item_col, item_text, window)):
        if names:
            # One chunk at a time is with the tasks; the next pass starts from what is written.
            marked = staged(marked, "searched")
        names.append(f"found{k}")
        found = _finder(docs.sparkSession.sparkContext.broadcast(chunk), sizes())
        marked = marked.withColumn(names[-1], found(F.col("text")))
    if len(names) == 1:
        spans, items = F.col("found0.spans"), F.col("found0.items")
    else:
        spans = F.array_sort(F.array_distinct(F.concat(*[f"{name}.spans" for name in names])))
        items = F.array_sort(F.array_distinct(F.concat(*[f"{name}.items" for name in names])))
    return marked.select(
        "id",
        F.col("found0.n_words").alias("n_words"),
        _covered_words(spans).alias("n_hit"),
        items.alias("items"),
        spans.alias("spans"),
        (F.size(spans) > 0).alias("contaminated"),
        *(["row"] if carry else []),
    )


def decontaminated(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW
) -> DataFrame:
    """The rows of ``docs``, all columns, whose texts have no window of the benchmark."""
    marked = mark(docs, benchmark, docs.columns[0], text, window=window, carry=docs.columns)
    return marked.where(~F.col("contaminated")).select(
        *[F.col("row").getField(c).alias(c) for c in docs.columns]
    )


def longest_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """(item, n_words, id, start) per item with a window in some text.

    The longest verbatim match that begins at a window of the item, and where: the
    smallest document id that has one of this length, and the word it begins at there.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text).cast("string").alias("text")
    )
    schema = "item string, n_words long, id long, start long"
    parts = []
    for chunk in chunks(benchmark, item_col, item_text, window):
        shared = docs.sparkSession.sparkContext.broadcast(chunk)

        def best(batches, shared=shared, size=sizes()):
            bench = shared.value
            for batch in batches:
                yield _longest(batch, bench, size)

        parts.append(staged(_least_of(rows.mapInArrow(best, schema)), "longest"))
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return _least_of(union)


def _least_of(found: DataFrame) -> DataFrame:
    """Per item the longest match, of the smallest id (null last), of the first word."""
    order = F.struct(-F.col("n_words"), F.col("id").isNull(), "id", "start")
    best = F.min_by(F.struct("n_words", "id", "start"), order).alias("best")
    return found.groupBy("item").agg(best).select("item", "best.*")


def _longest(batch: pa.RecordBatch, bench: Benchmark, size: Sizes) -> pa.RecordBatch:
    table = pa.table([batch["id"], batch["text"]], ["id", "text"])
    # By id, so that the first of several shards and rows has the smallest.
    table = table.sort_by([("id", "ascending"), ("text", "ascending")])
    data, offsets = text_bytes(table["text"])
    best: dict[int, tuple[int, int, int]] = {}
    for a, b in row_slices(offsets, size.shard):
        own = offsets[a : b + 1] - offsets[a]
        found = search(data[offsets[a] : offsets[b]], own, bench, size)
        whole = np.flatnonzero((found.longest >= bench.size) & (found.longest > 0))
        for k in whole[np.argsort(-found.longest[whole], kind="stable")].tolist():
            c, length = int(bench.item[k]), int(found.longest[k])
            if c in best and best[c][0] > length:
                continue
            word = int(found.places[found.lo[k] : found.hi[k]].min())
            row = int(np.searchsorted(found.bounds, word, side="right")) - 1
            # Rows are in the order of their ids: the first row and word are the least.
            new = (length, -(a + row), -(word - int(found.bounds[row])))
            best[c] = max(best.get(c, new), new)
    lines = [(name, n, -row, -at) for c, (n, row, at) in best.items() for name in bench.ids[c]]
    names, n_words, rows, starts = zip(*lines, strict=True) if lines else ((), (), (), ())
    return pa.record_batch(
        [
            pa.array(names, pa.string()),
            pa.array(n_words, pa.int64()),
            table["id"].combine_chunks().take(pa.array(rows, pa.int64())).cast(pa.int64()),
            pa.array(starts, pa.int64()),
        ],
        ["item", "n_words", "id", "start"],
    )
