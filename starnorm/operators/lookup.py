"""Left join of a large table to one with a row per key, safe against hot keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starnorm.operators.dedupe import one_row_per_key
from starnorm.operators.keys import common_type, in_type, may_merge
from starnorm.sizing import BROADCAST_BYTES, fits
from starnorm.staging import staged

# A key is hot when it holds more than one part in HOT_PARTS of the rows, so there
# are fewer than HOT_PARTS hot keys however large the table is.
HOT_PARTS = 20_000
# Parts a hot key is split into where its row is too wide to broadcast.
SALTS = 64
# Keys are counted by a hash of so many values before any is counted by itself.
BUCKETS = 1 << 16


def _matches(left: Sequence[str], right: Sequence[str], null_safe: bool) -> Column:
    pairs = [(F.col(a), F.col(b)) for a, b in zip(left, right, strict=True)]
    return reduce(and_, (a.eqNullSafe(b) if null_safe else a == b for a, b in pairs))


def _hot_keys(source: DataFrame, keys: Sequence[Column]) -> DataFrame:
    """The keys that hold an outsized share of the rows of ``source``, counted exactly.

    A hot key makes its bucket a crowded one, so only the keys of crowded buckets are
    counted one by one: what is shuffled is at most ``BUCKETS`` rows a task, and keys that
    are few or hot.
    """
    names = [f"__on{i}" for i in range(len(keys))]
    rows = source.select(*[c.alias(n) for n, c in zip(names, keys, strict=True)])
    rows = rows.withColumn("__bucket", F.pmod(F.xxhash64(*names), F.lit(BUCKETS)).cast("int"))
    buckets = staged(rows.groupBy("__bucket").agg(F.count("*").alias("__size")), "buckets")
    total = buckets.agg(F.sum("__size").alias("n")).first()["n"] or 0
    crowded = buckets.filter(F.col("__size") * HOT_PARTS > total).select("__bucket")
    if crowded.isEmpty():
        return rows.select(*names).limit(0)
    rows = rows.join(F.broadcast(crowded), "__bucket", "left_semi")
    counts = rows.groupBy(*names).count()
    return counts.filter(F.col("count") * HOT_PARTS > total).drop("count")


def _first_of_each(
    right: DataFrame, keys: Sequence[str], stored: Sequence[str], row_count: str | None
) -> DataFrame:
    """One row per aligned key, with the fact rows of all keys that became it.

    A key that is no value of the wanted type is null and goes: it has no partner, and
    must not become one of a null key.
    """
    lost = reduce(
        or_, (F.col(k).isNull() & F.col(s).isNotNull() for k, s in zip(keys, stored, strict=True))
    )
    right = right.filter(~lost)
    if row_count:
        total = F.sum("__rows").over(Window.partitionBy(*keys))
        right = right.withColumn("__rows", total)
    return one_row_per_key(right, keys, order_by=stored)


def lookup(
    facts: DataFrame,
    table: DataFrame,
    on: Mapping[str, str],
    take: Mapping[str, str],
    *,
    null_safe: bool = False,
    row_count: str | None = None,
    small: bool | None = None,
    source: DataFrame | None = None,
    spread_by: Sequence[str] | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add columns of ``table``, which has one row per key, to every row of ``facts``.

    ``on`` maps fact columns to key columns, ``take`` maps new names to columns of
    ``table``. Rows without a partner get nulls; a null key has no partner unless
    ``null_safe``.

    Keys of unlike types are brought into one type first, whatever way the join goes;
    kinds that do not compare raise. Keys of ``table`` that become one key there, as
    '1' and '01' do next to a number, are one row: the first by its key as stored, then
    by what is taken. So a row of ``facts`` is one row of the result.

    A table measured to fit ``broadcast_bytes`` is broadcast and ``facts`` does not
    move. Beyond that both sides are shuffled on the key, except that the few hot
    keys are served from a small broadcast and their rows, like those with a null
    key, are spread evenly instead of meeting in one task. Hot keys whose columns are
    too wide for that are split on both sides instead.

    ``row_count`` names a column of ``table`` with the fact rows per key, if known;
    ``small`` is the outcome of an earlier measurement of the same columns.
    ``source`` is a cheaper frame with the rows and join columns of ``facts``, used
    to count. ``spread_by`` names the fact columns the spreading hashes (default: all
    but the join columns).
    """
    keys = [f"__key{i}" for i in range(len(on))]
    left_types = [facts.schema[c].dataType for c in on]
    right_types = [table.schema[c].dataType for c in on.values()]
    kinds = [common_type(a, b) for a, b in zip(left_types, right_types, strict=True)]
    fact_keys = [in_type(F.col(c), t, k) for c, t, k in zip(on, left_types, kinds, strict=True)]
    # A key that needs no other type is shuffled once, as the column it is.
    same = [t == k for t, k in zip(left_types, kinds, strict=True)]
    on_columns = [c if s else f"__fk{i}" for i, (c, s) in enumerate(zip(on, same, strict=True))]
    keyed = facts.withColumns(
        {n: k for n, k, s in zip(on_columns, fact_keys, same, strict=True) if not s}
    )
    extra = [F.col(row_count).alias("__rows")] if row_count else []
    stored = [f"__stored{i}" for i in range(len(on))]
    extra += [F.col(c).alias(name) for name, c in zip(stored, on.values(), strict=True)]
    right = table.select(
        *[
            in_type(F.col(c), t, k).alias(name)
            for name, c, t, k in zip(keys, on.values(), right_types, kinds, strict=True)
        ],
        *[F.col(c).alias(f"__take{i}") for i, c in enumerate(take.values())],
        *extra,
    )
    taken = [f"__take{i}" for i in range(len(take))]
    if any(may_merge(t, k) for t, k in zip(right_types, kinds, strict=True)):
        right = _first_of_each(right, keys, stored, row_count)
    matched = _matches(on_columns, keys, null_safe)
    converted = null_safe and not all(same)
    if converted:
        # A key that is no value of the wanted type is null now, but matches no null.
        lost = (F.col(c).isNull() & F.col(raw).isNotNull() for c, raw in zip(on_columns, on, strict=True))
        keyed = keyed.withColumn("__lost", reduce(or_, lost))
        matched &= ~F.col("__lost")

    partners = right.select(*keys, *taken)
    if small is None:
        small = fits(partners, broadcast_bytes)
    if small:
        joined = keyed.join(F.broadcast(partners), matched, "left")
        return joined.select(
            *facts.columns, *[F.col(t).alias(n) for t, n in zip(taken, take, strict=True)]
        )

    if row_count:
        total = right.agg(F.sum("__rows").alias("n")).first()["n"] or 0
        hot = right.filter(F.col("__rows") * HOT_PARTS > total)
    else:
        heavy = _hot_keys(facts if source is None else source, fact_keys)
        same_key = _matches(heavy.columns, keys, null_safe)
        hot = right.join(F.broadcast(heavy), same_key, "left_semi")
    hot = staged(
        hot.select(
            *[F.col(c).alias(f"__hot{c}") for c in [*keys, *taken]], F.lit(True).alias("__hot")
        ),
        "hot-keys",
    )
    hot_matched = _matches(on_columns, [f"__hot{k}" for k in keys], null_safe)
    if converted:
        hot_matched &= ~F.col("__lost")
    # The input partition keeps exact copies of a row apart; both parts of the seed
    # are the same when a lost task runs again.
    seed = spread_by or [c for c in facts.columns if c not in on] or facts.columns
    spread = F.xxhash64(F.spark_partition_id(), *seed)
    if not fits(hot, max(broadcast_bytes, BROADCAST_BYTES)):
        joined = _salted(keyed, partners, hot, on_columns, keys, matched, spread, null_safe)
        return joined.select(
            *facts.columns, *[F.col(t).alias(n) for t, n in zip(taken, take, strict=True)]
        )
    any_hot = not hot.isEmpty()
    facts_hot = keyed.join(F.broadcast(hot), hot_matched, "left") if any_hot else keyed

    # Rows are shuffled and sorted on their key and a salt, which is zero. Rows that are
    # served already, or have no partner, take a salt of their own instead and meet no one.
    served = F.col("__hot").isNotNull() if any_hot else F.lit(False)
    if not null_safe:
        served = reduce(or_, (F.col(c).isNull() for c in on_columns), served)
    own_salt = F.pmod(spread, F.lit(1 << 30)) + 1
    facts_salted = facts_hot.withColumn("__salt", F.when(served, own_salt).otherwise(F.lit(0)).cast("long"))
    # Zero, but no constant: the optimizer would drop that from the columns of the shuffle.
    zero = F.pmod(F.xxhash64(*keys), F.lit(1).cast("long"))
    # Measured as too large: no later guess of its size should broadcast it after all.
    cold = partners.withColumn("__key_salt", zero).hint("merge")
    joined = facts_salted.join(cold, (F.col("__salt") == F.col("__key_salt")) & matched, "left")
    if not any_hot:
        return joined.select(
            *facts.columns, *[F.col(t).alias(n) for t, n in zip(taken, take, strict=True)]
        )
    return joined.select(
        *facts.columns,
        *[
            F.when(F.col("__hot").isNotNull(), F.col(f"__hot{t}")).otherwise(F.col(t)).alias(n)
            for t, n in zip(taken, take, strict=True)
        ],
    )


def _salted(
    keyed: DataFrame,
    partners: DataFrame,
    hot: DataFrame,
    on_columns: Sequence[str],
    keys: Sequence[str],
    matched: Column,
    spread: Column,
    null_safe: bool,
) -> DataFrame:
    """Join on slots, the rows of a hot key dealt over ``SALTS`` of them.

    Only hashes of the hot keys are broadcast, eight bytes each. A key that shares its
    hash with a hot one is split along with it.
    """
    hashes = hot.select(F.xxhash64(*[f"__hot{k}" for k in keys]).alias("__hot_hash")).distinct()
    hashes = F.broadcast(hashes)
    salt = F.pmod(spread, F.lit(SALTS))
    is_hot = F.col("__hot_hash").isNotNull()
    slot = F.when(is_hot, F.xxhash64(*on_columns, salt)).otherwise(F.xxhash64(*on_columns))
    if not null_safe:
        no_key = reduce(or_, (F.col(c).isNull() for c in on_columns))
        slot = F.when(no_key, spread).otherwise(slot)
    left = (
        keyed.withColumn("__hash", F.xxhash64(*on_columns))
        .join(hashes, F.col("__hash") == F.col("__hot_hash"), "left")
        .withColumn("__slot", slot)
        .drop("__hash", "__hot_hash")
    )
    every_salt = F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))
    right = (
        partners.withColumn("__hash", F.xxhash64(*keys))
        .join(hashes, F.col("__hash") == F.col("__hot_hash"), "left")
        .withColumn("__salt", F.explode(F.when(is_hot, every_salt).otherwise(F.array(F.lit(-1).cast("long")))))
        .withColumn(
            "__key_slot",
            F.when(is_hot, F.xxhash64(*keys, F.col("__salt"))).otherwise(F.col("__hash")),
        )
        .drop("__hash", "__hot_hash", "__salt")
    )
    return left.join(right, (F.col("__slot") == F.col("__key_slot")) & matched, "left")
