"""Components of documents linked by the Jaccard similarity of their word n-grams.

A link of similarity t between sets of sizes a and b needs an overlap of at least
t / (1 + t) * (a + b). From this follow the bounds that discard pairs: sizes differ by
no more than the factor t; at least the share t of a document's n-grams is in another
document; and the two share one of their rarest n-grams, early enough that what comes
after it can still make up the overlap.

1. A merged sketch tells each block how common its n-grams may be. Documents too few of
   whose n-grams occur elsewhere link with nothing. The others keep their set, and its
   rarest n-grams by (level of the count, hash), an order all blocks agree on.
2. Equal sets are one node. In each list of nodes that share a rare n-gram, all are
   compared with the list's first: a star instead of all pairs.
3. Lists whose nodes are then in one component are done. In the rest, pairs from
   different components are compared, but for those that the triangle inequality of
   the Jaccard distance rules out.

Comparing is a blocked product of the sparse document by n-gram matrix with itself,
masked by the pairs asked for: blocks of a bounded number of pairs, a hot document's
pairs dealt over several, each accumulating overlap counts. No list of copies is ever
expanded into its pairs, and nothing but counts comes to the driver.

Null texts and texts without words have an empty set and link with nothing. Rows with
a null id take part and never name a component. Equal rows link. Columns other than id
and text are ignored or, where documents are returned, carried along.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starnorm.llm.blocks import (
    blocked,
    in_order,
    messages,
    quoted,
    text_size,
    unused_name,
)
from starnorm.llm.components import components
from starnorm.llm.routes import network
from starnorm.llm.sketch import Sketch
from starnorm.llm.sketch import merged as counters_merged
from starnorm.llm.spans import (
    LOWER,
    SEEDS,
    group_starts,
    hash_spans,
    mixed,
    ranges,
    text_bytes,
    window_hash,
    windows_inside,
    word_spans,
)
from starnorm.operators.lookup import lookup
from starnorm.staging import staged

WORDS = 4
PERCENT = 85
# Pairs compared in one task.
TILE = 1500
# Rows of keys, under 100 bytes each, that may be sent to every task.
BROADCAST_ROWS = 200_000

# Counters of the sketch per n-gram.
SPARE = 4

_SETS = "n long, key binary, holder boolean, skipped int, early array<bigint>, words binary"


def gram_sets(data: np.ndarray, offsets: np.ndarray, words: int):
    """The distinct word n-grams of each text, sorted, and where each text's begin.

    A text of fewer words has one n-gram: all of them.
    """
    data = LOWER[data]
    starts, ends, bounds = word_spans(data, offsets)
    h = hash_spans(data, starts, ends)[0]
    n_words = np.diff(bounds)
    rows = np.arange(n_words.size)
    grams = [window_hash(h, words)[windows_inside(bounds, words)]]
    owner = [np.repeat(rows, np.maximum(0, n_words - words + 1))]
    for k in range(1, words):
        own = np.flatnonzero(n_words == k)
        if own.size:
            grams.append(window_hash(h, k, SEEDS[1] + k)[bounds[own]])
            owner.append(own)
    all_grams, owners = np.concatenate(grams), np.concatenate(owner)
    order = np.lexsort((all_grams, owners))
    all_grams, owners = all_grams[order], owners[order]
    new = np.ones(all_grams.size, bool)
    new[1:] = (all_grams[1:] != all_grams[:-1]) | (owners[1:] != owners[:-1])
    return all_grams[new], np.searchsorted(owners[new], np.arange(n_words.size + 1))


class _Sets:
    """The n-gram sets of a block's rows in (id, text) order, and the distinct sets."""

    def __init__(self, table: pa.Table, words: int):
        self.table = in_order(table)
        self.data, self.offsets = text_bytes(self.table["text"])
        self.grams, self.bounds = gram_sets(self.data, self.offsets, words)
        self.n = np.diff(self.bounds)
        self.key = np.zeros((self.n.size, 2), np.uint64)
        for k, seed in enumerate(SEEDS):
            total = np.cumsum(mixed(self.grams + np.uint64(seed)), dtype=np.uint64)
            total = np.concatenate([np.zeros(1, np.uint64), total])
            self.key[:, k] = total[self.bounds[1:]] - total[self.bounds[:-1]]
        order = np.lexsort((np.arange(self.n.size), self.key[:, 1], self.key[:, 0]))
        new = np.ones(order.size, bool)
        new[1:] = (self.key[order[1:]] != self.key[order[:-1]]).any(axis=1)
        first = np.flatnonzero(new)
        copies = np.diff(np.append(first, order.size))
        self.leader = np.empty(order.size, np.int64)  # first row with the same set
        self.leader[order] = np.repeat(order[first], copies)
        self.copies = np.zeros(order.size, np.int64)
        self.copies[order[first]] = copies
        self.holders = order[first][self.n[order[first]] > 0]

    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All n-grams of the distinct sets, sorted; where each comes first; how often."""
        own = self.grams[ranges(self.bounds[self.holders], self.n[self.holders])]
        order = np.argsort(own, kind="stable")
        first = group_starts(own[order])
        return own[order][first], order, np.diff(np.append(first, own.size))


def _needed(n, percent: int):
    """The least overlap with any other set that makes a link: ``percent`` of ``n``."""
    return -(-percent * n // 100)


def _rare(sets: _Sets, level: np.ndarray, percent: int) -> pa.Table:
    """Rows with key, and for the first row of each distinct set what comparing needs."""
    size = sets.n[sets.holders]
    start = np.cumsum(size) - size
    common = np.concatenate([[0], np.cumsum(level > 0)])
    repeated = common[start + size] - common[start]
    alive = (repeated >= _needed(size, percent)) | (sets.copies[sets.holders] > 1)
    holder = np.zeros(sets.n.size, bool)
    holder[sets.holders[alive]] = True
    early: list[list[int] | None] = [None] * sets.n.size
    skipped: list[int | None] = [None] * sets.n.size
    raw: list[bytes | None] = [None] * sets.n.size
    for k in np.flatnonzero(alive):
        row = sets.holders[k]
        grams = sets.grams[sets.bounds[row] : sets.bounds[row + 1]]
        own = level[start[k] : start[k] + size[k]]
        order = np.lexsort((grams, own))
        keep = int(size[k] - _needed(size[k], percent) + 1)
        # What is certainly in no other set comes first and need not be listed.
        skipped[row] = int(np.count_nonzero(own == 0))
        early[row] = grams[order[skipped[row] : keep]].view(np.int64).tolist()
        raw[row] = sets.data[sets.offsets[row] : sets.offsets[row + 1]].tobytes()
    candidate = holder[sets.leader]
    key = [k.tobytes() if c else None for k, c in zip(sets.key, candidate, strict=True)]
    return pa.table(
        {
            "n": pa.array(sets.n, pa.int64()),
            "key": pa.array(key, pa.binary()),
            "holder": pa.array(holder),
            "skipped": pa.array(skipped, pa.int32()),
            "early": pa.array(early, pa.list_(pa.int64())),
            "words": pa.array(raw, pa.binary()),
        }
    )


def candidate_sets(docs: DataFrame, id_col: str, text: str, words: int, percent: int) -> DataFrame:
    """(id, print, n, key, holder, skipped, early, words) per row.

    ``key`` is null where no link is possible. The rest is filled in for one row of
    each distinct set in a block.
    """
    _, size = text_size(docs, text)
    texts = blocked(docs, id_col, text, size)
    sketch = Sketch(size // 5, 1, SPARE)

    def counted(table: pa.Table) -> pa.Table:
        sets = _Sets(table, words)
        grams, _, counts = sets.distinct()
        return messages(list(sketch.parts(grams, counts, table["block"][0].as_py())))

    def rated(table: pa.Table, answers: pa.Table) -> pa.Table:
        sets = _Sets(table, words)
        grams, order, counts = sets.distinct()
        level = np.empty(order.size, np.uint8)
        level[order] = np.repeat(sketch.read(grams, answers, levels=True), counts)
        found = _rare(sets, level, percent)
        return found.add_column(0, "print", sets.table["print"]).add_column(0, "id", sets.table["id"])

    route = network(size, sketch.shards)
    counts = route.from_blocks(texts, counted)
    levels = route.at_shards(counts, lambda t: counters_merged(t, levels=True))
    return route.by_block(texts, levels, rated, f"id long, print long, {_SETS}")


def _product(table: pa.Table, words: int) -> pa.Table:
    """Overlap counts of the pairs (a, b) in a tile.

    Rows with a null ``b`` bring the texts of ``a``, the others those of ``b``.
    """
    a = table["a"].combine_chunks().dictionary_encode()
    left = np.asarray(table["b"].combine_chunks().is_null())
    owner = a.indices.to_numpy()
    grams, bounds = gram_sets(*text_bytes(table["words"]), words)
    row = np.repeat(np.arange(owner.size), np.diff(bounds))
    # Columns of the incidence matrix: (a, n-gram). A pair's overlap is what it shares.
    column = mixed(owner[row].astype(np.uint64) + np.uint64(1)) ^ grams
    of_left = left[row]
    known = np.sort(column[of_left])
    asked, asking = column[~of_left], row[~of_left]
    if known.size:
        at = np.minimum(np.searchsorted(known, asked), known.size - 1)
        asking = asking[known[at] == asked]
    else:
        asking = asking[:0]
    overlap = np.bincount(asking, minlength=owner.size)
    pairs = table.select(["a", "b"]).append_column("overlap", pa.array(overlap, pa.int64()))
    return pairs.filter(pa.array(~left))


def _sent_if_small(rows: DataFrame, n_rows: int) -> DataFrame:
    """The same rows, broadcast if a count has shown that they are few."""
    return F.broadcast(rows) if n_rows <= BROADCAST_ROWS else rows


def overlaps(pairs: DataFrame, sets: DataFrame, words: int) -> DataFrame:
    """Pairs (a, b) of keys -> (a, b, overlap), by tiles of about ``TILE`` pairs.

    ``sets`` has one row (key, words) per key. The pairs of an ``a`` that has many
    are dealt over several tiles.
    """
    n_pairs = pairs.count()
    tiles = max(1, -(-n_pairs // TILE))
    parts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / TILE).alias("_parts"))
    dealt = pairs.join(parts, "a").select(
        "a",
        "b",
        F.expr(f"cast(pmod(xxhash64(a, pmod(xxhash64(b), _parts)), {tiles}) as int)").alias("tile"),
    )
    asked = _sent_if_small(dealt, n_pairs)
    right = sets.withColumnRenamed("key", "b").join(asked, "b").select("tile", "a", "b", "words")
    asked = _sent_if_small(dealt.select("tile", "a").distinct(), n_pairs)
    left = (
        sets.withColumnRenamed("key", "a")
        .join(asked, "a")
        .select("tile", "a", F.lit(None).cast("binary").alias("b"), "words")
    )
    tiled = left.union(right).groupBy("tile")
    return tiled.applyInArrow(lambda t: _product(t, words), "a binary, b binary, overlap long")


def _could_link(a: str, b: str, percent: int) -> str:
    """What sizes and places in the rarity order allow, for columns with prefixes a and b.

    If the shared n-gram is the first they share, the overlap is at most what is left of
    either list from there on.
    """
    need = f"ceil({percent} * ({a}n + {b}n) / {100 + percent}D - 1e-9)"
    return (
        f"100 * least({a}n, {b}n) >= {percent} * greatest({a}n, {b}n)"
        f" AND least({a}n - {a}place, {b}n - {b}place) >= {need}"
    )


def _linked(compared: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """(a, b, distance, linked) of compared pairs."""
    sized = compared.join(sizes.select(F.col("key").alias("a"), F.col("n").alias("na")), "a").join(
        sizes.select(F.col("key").alias("b"), F.col("n").alias("nb")), "b"
    )
    union = F.col("na") + F.col("nb") - F.col("overlap")
    return sized.select(
        "a",
        "b",
        (1 - F.col("overlap") / union).alias("distance"),
        (100 * F.col("overlap") >= percent * union).alias("linked"),
    )


def node_components(rows: DataFrame, words: int, percent: int) -> DataFrame:
    """Staged candidate rows -> (node, component) of the keys that link with others."""
    held = rows.where("holder")
    # One text for each set; blocks that hold the same set each sent one.
    sets = staged(
        held.groupBy("key").agg(F.min_by("words", F.struct("id", "print")).alias("words")), "sets"
    )
    nodes = staged(
        held.groupBy("key").agg(F.first(F.struct("n", "skipped", "early")).alias("node")).select(
            "key", "node.*"
        ),
        "nodes",
    )
    lists = _heads(nodes)

    def compared(pairs: DataFrame) -> DataFrame:
        found = _linked(overlaps(pairs, sets, words), nodes.select("key", "n"), percent)
        return staged(found, "compared")

    def merged(grouped: DataFrame, found: DataFrame) -> DataFrame:
        # Components so far are stars; new links connect them.
        rays = grouped.select(F.col("node").alias("u"), F.col("component").alias("v"))
        links = found.where("linked").select(F.col("a").alias("u"), F.col("b").alias("v"))
        return components(rays.union(links))

    none = lists.where("false").select(F.col("key").alias("node"), F.col("key").alias("component"))
    to_heads = lists.where("key <> head").where(_could_link("head_", "", percent))
    # First each node with the best of its heads alone: a family of copies has few.
    first = staged(
        to_heads.groupBy("key")
        .agg(F.min(F.struct("head_own", "head")).alias("best"))
        .select(F.col("best.head").alias("a"), F.col("key").alias("b")),
        "stars",
    )
    found = compared(first)
    grouped = merged(none, found)
    # Then with the other heads of lists that are not in one component by now.
    open_lists = staged(_unsettled(lists, grouped), "unsettled")
    more = (
        open_lists.where("key <> head AND component <> head_component")
        .where(_could_link("head_", "", percent))
        .select(F.col("head").alias("a"), F.col("key").alias("b"))
        .distinct()
        .join(first, ["a", "b"], "left_anti")
    )
    found = found.union(compared(staged(more, "stars")))
    grouped = merged(grouped, found)
    # Then what such lists hold apart, without their heads.
    pairs = staged(_apart(_unsettled(open_lists, grouped), found, percent), "pairs")
    return grouped if pairs.isEmpty() else merged(grouped, compared(pairs))


def _heads(nodes: DataFrame) -> DataFrame:
    """(gram, key, n, place, head, ...) of n-grams listed by several nodes, written once.

    The head of a list is the node with the smallest share of n-grams of its own: among
    near copies the one with the fewest edits, which links with the most others.
    """
    lists = nodes.select("key", "n", "skipped", F.posexplode("early").alias("at", "gram")).select(
        "gram",
        "key",
        "n",
        (F.col("skipped") + F.col("at")).alias("place"),
        (F.col("skipped") / F.col("n")).cast("float").alias("own"),
    )
    heads = (
        lists.groupBy("gram")
        .agg(F.min(F.struct("own", "key", "n", "place")).alias("h"), F.count(F.lit(1)).alias("nodes"))
        .where("nodes > 1")
        .selectExpr(
            "gram",
            "h.own AS head_own",
            "h.key AS head",
            "h.n AS head_n",
            "h.place AS head_place",
            "nodes",
        )
    )
    taken = ["head_own", "head", "head_n", "head_place"]
    return staged(_of_list(lists.drop("own"), staged(heads, "heads"), taken), "lists")


def _of_list(rows: DataFrame, lists: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of the given lists with what is known of the whole list; others go.

    ``lists`` counts its ``nodes``, so that a list that very many share does not meet in
    one task.
    """
    found = lookup(rows, lists, {"gram": "gram"}, {c: c for c in columns}, row_count="nodes")
    return found.where(F.col(columns[0]).isNotNull())


def _unsettled(lists: DataFrame, grouped: DataFrame) -> DataFrame:
    """The lists whose nodes are not all in one component, with components."""
    plain = lists.select("gram", "key", "n", "place", "head", "head_n", "head_place")
    named = grouped.select(F.col("node").alias("key"), "component")
    labelled = plain.join(_sent_if_small(named, grouped.count()), "key", "left").withColumn(
        "component", F.coalesce("component", "key")
    )
    # The head is in its own list, so its component is one of the list's.
    ends = labelled.groupBy("gram").agg(
        F.min("component").alias("low"),
        F.max("component").alias("high"),
        F.max(F.when(F.col("key") == F.col("head"), F.col("component"))).alias("head_component"),
        F.count(F.lit(1)).alias("nodes"),
    )
    mixed_lists = staged(ends.where("low <> high").drop("low", "high"), "mixed-lists")
    return _of_list(labelled, mixed_lists, ["head_component"])


def _apart(lists: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that share a list, lie in different components and might link."""
    far = found.select(F.col("a").alias("head"), F.col("b").alias("key"), "distance")
    rows = staged(
        lists.where("key <> head")
        .select("gram", "key", "n", "place", "component", "head")
        .join(far, ["head", "key"], "left"),
        "apart",
    )
    left, right = (
        rows.selectExpr("gram", *(f"{c} AS {side}{c}" for c in rows.columns if c != "gram"))
        for side in ("a_", "b_")
    )
    return (
        left.join(right, "gram")
        .where("a_key < b_key AND a_component <> b_component")
        .where(_could_link("a_", "b_", percent))
        .where(f"coalesce(abs(a_distance - b_distance), 0) <= {1 - percent / 100} + 1e-9")
        .select(F.col("a_key").alias("a"), F.col("b_key").alias("b"))
        .distinct()
    )


def _grouped_rows(docs, id_col, text, words, percent) -> tuple[DataFrame, DataFrame]:
    """All rows (id, print, n, key), and those with a key also with their component."""
    rows = staged(candidate_sets(docs, id_col, text, words, percent), "candidates")
    grouped = node_components(rows, words, percent)
    slim = rows.select("id", "print", "n", "key")
    placed = (
        slim.where("key IS NOT NULL")
        .join(grouped.select(F.col("node").alias("key"), "component"), "key", "left")
        .withColumn("component", F.coalesce("component", "key"))
    )
    return slim, placed


def jaccard_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """(id, n_shingles, component_id) per row.

    Rows link when 100 * overlap >= percent * union. ``component_id`` is the smallest
    id that links lead to, the row's own included.
    """
    slim, placed = _grouped_rows(docs, id_col, text, words, percent)
    least = staged(
        placed.groupBy("component").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("rows")),
        "least",
    )
    # A component may hold a third of all rows.
    joined = lookup(placed, least, {"component": "component"}, {"least": "least"}, row_count="rows")
    linked = joined.select("id", "n", "least")
    alone = slim.where("key IS NULL").select("id", "n", F.col("id").alias("least"))
    return linked.union(alone).select(
        "id", F.col("n").alias("n_shingles"), F.col("least").alias("component_id")
    )


def keep_one_of_each_component(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """The rows of ``docs`` but for linked ones that are not the first of their component.

    First is the smallest id, null last, then the hash of the text. Of equal rows one
    stays. Texts without words are all kept.
    """
    _, placed = _grouped_rows(docs, id_col, text, words, percent)
    first = staged(
        placed.groupBy("component")
        .agg(
            F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "print")).alias("first"),
            F.count(F.lit(1)).alias("rows"),
        )
        .selectExpr("component", "first.id AS first_id", "first.print AS first_print", "rows"),
        "first",
    )
    taking = {"first_id": "first_id", "first_print": "first_print"}
    joined = lookup(placed, first, {"component": "component"}, taking, row_count="rows")
    taken = docs.columns
    i, fingerprint, stays, turn = (
        unused_name(f"_{name}", taken) for name in ("id", "print", "stays", "turn")
    )
    verdict = (
        joined.select(
            F.col("id").alias(i),
            F.col("print").alias(fingerprint),
            (F.col("id").eqNullSafe(F.col("first_id")) & (F.col("print") == F.col("first_print")))
            .alias(stays),
        )
        .distinct()
    )
    own = unused_name("_own_print", taken)
    keyed = docs.withColumn(own, F.xxhash64(F.col(text)))
    same = F.col(id_col).cast("long").eqNullSafe(F.col(i)) & (F.col(own) == F.col(fingerprint))
    nth = F.row_number().over(Window.partitionBy(id_col, own).orderBy(F.lit(0)))
    return (
        keyed.join(verdict, same, "left")
        .withColumn(turn, F.when(F.col(stays), nth))
        .where(F.col(stays).isNull() | (F.col(stays) & (F.col(turn) == 1)))
        .select(*[F.col(quoted(c)) for c in docs.columns])
    )
