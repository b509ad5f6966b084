"""The three kinds of dimension: source-keyed, natural-keyed and with a status."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from graphlib import CycleError, TopologicalSorter
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starnorm.functions.activity import ACTIVE, CUTOFF, INACTIVE, activity_status, as_timestamp
from starnorm.functions.nulls import any_null
from starnorm.operators.dedupe import one_row_per_key
from starnorm.operators.dense_key import dense_key, dense_keys


def keyed_dim(
    df: DataFrame,
    key: str,
    attributes: Sequence[str],
    *,
    order_by: Sequence[str] = (),
    keep: str = "first",
    drop_all_null: bool = False,
    drop_null_key: bool = False,
) -> DataFrame:
    """One row per source key.

    ``drop_all_null`` removes rows that are null throughout before a winner is
    picked; a null key with any other value then survives as a row, unless
    ``drop_null_key`` is set.
    """
    rows = df.select(key, *attributes)
    if drop_null_key:
        rows = rows.filter(F.col(key).isNotNull())
    elif drop_all_null:
        rows = rows.dropna(how="all")
    return one_row_per_key(rows, [key], order_by=order_by, keep=keep)


def natural_dim(
    df: DataFrame,
    natural_key: Sequence[str],
    id_name: str,
    *,
    drop_all_null: bool = False,
    row_count: str | None = None,
) -> DataFrame:
    """Distinct natural keys with a dense surrogate, surrogate first.

    ``row_count`` adds the number of source rows behind each key, which a later
    join can use to tell its hot keys at no further cost.
    """
    rows = df.select(*natural_key)
    if drop_all_null:
        rows = rows.dropna(how="all")
    if row_count is None:
        return dense_key(rows.distinct(), natural_key, id_name)
    counted = rows.groupBy(*natural_key).agg(F.count("*").alias(row_count))
    return dense_key(counted, natural_key, id_name)


@dataclass(frozen=True)
class Numbered:
    """A natural-keyed dimension among several built in one pass; see :func:`natural_dims`."""

    natural_key: tuple[str, ...]
    id_name: str
    drop_all_null: bool = False


def in_one_order(keys: Iterable[Sequence[str]]) -> list[str] | None:
    """All columns in an order that keeps every key's own; None if no order does."""
    after: dict[str, set[str]] = {}
    for key in keys:
        for i, column in enumerate(key):
            after.setdefault(column, set()).update(key[:i])
    try:
        return list(TopologicalSorter(after).static_order())
    except CycleError:
        return None


def natural_dims(
    df: DataFrame, dims: Mapping[str, Numbered], row_count: str = "n_rows"
) -> dict[str, DataFrame]:
    """Several natural-keyed dimensions from one scan, one shuffle and one sort.

    The keys of all dimensions are the grouping sets of one aggregation, which counts the
    rows behind each key and leaves a task with a key once, however hot it is. The keys of
    all sets are then sorted and numbered together, within their set.

    Each result has its surrogate first, its key, and ``row_count``. They read one staged
    table, sorted by dimension. Where two keys have the same columns, but not the same
    order or treatment of nulls, or where their orders contradict each other, all are
    built one by one.
    """
    flags: dict[tuple[str, ...], set[bool]] = {}
    for dim in dims.values():
        flags.setdefault(dim.natural_key, set()).add(dim.drop_all_null)
    keys = list(flags)
    columns = in_one_order(keys)
    alike = len({frozenset(key) for key in keys}) < len(keys) or any(len(f) > 1 for f in flags.values())
    if columns is None or len(keys) < 2 or alike:
        return {
            name: natural_dim(
                df, dim.natural_key, dim.id_name, drop_all_null=dim.drop_all_null, row_count=row_count
            )
            for name, dim in dims.items()
        }
    stand_ins = {c: f"__c{i}" for i, c in enumerate(columns)}
    sets = [[F.col(stand_ins[c]) for c in key] for key in keys]
    rows = df.select(*[F.col(c).alias(s) for c, s in stand_ins.items()])
    grouped = rows.groupingSets(sets, *[F.col(s) for s in stand_ins.values()]).agg(
        F.grouping_id().alias("__set"), F.count(F.lit(1)).alias("__rows")
    )
    # In the number of a set, the bit of a column it lacks is set, the first column's highest.
    last = len(columns) - 1
    number = {
        key: sum(1 << last - i for i, c in enumerate(columns) if c not in key) for key in keys
    }
    for key in keys:
        if flags[key] == {True}:
            absent = reduce(and_, (F.col(stand_ins[c]).isNull() for c in key))
            grouped = grouped.filter((F.col("__set") != number[key]) | ~absent)
    numbered = dense_keys(grouped, ["__set"], list(stand_ins.values()), "__id")

    def of(dim: Numbered) -> DataFrame:
        return numbered.filter(F.col("__set") == number[dim.natural_key]).select(
            F.col("__id").alias(dim.id_name),
            *[F.col(stand_ins[c]).alias(c) for c in dim.natural_key],
            F.col("__rows").alias(row_count),
        )

    return {name: of(dim) for name, dim in dims.items()}


def last_activity(df: DataFrame, key: str, ts: str, name: str = "last_activity") -> DataFrame:
    """Latest timestamp per key."""
    moment = as_timestamp(F.col(ts), df.schema[ts].dataType)
    return df.groupBy(key).agg(F.max(moment).alias(name))


def status_dim(
    df: DataFrame,
    key: str,
    attributes: Sequence[str],
    ts: str,
    *,
    status: str = "status",
    cutoff: str = CUTOFF,
    inactive: str = INACTIVE,
    active: str = ACTIVE,
    order_by: Sequence[str] = (),
    keep: str = "first",
) -> DataFrame:
    """A keyed dimension with a status from the latest activity of the key.

    The latest timestamp and the winning row come out of one aggregate, so the
    source is shuffled once. A null key has no activity of its own and is active.
    """
    data_type = df.schema[ts].dataType
    moment = as_timestamp(F.col(ts), data_type).alias("__moment")
    rows = df.select(key, *attributes, moment)
    winner_fields = [c for c in order_by if c != key]
    winner_fields += [c for c in attributes if c not in winner_fields]
    pick = F.min if keep == "first" else F.max
    grouped = rows.groupBy(key).agg(
        F.max("__moment").alias("__last"), pick(F.struct(*winner_fields)).alias("__winner")
    )
    last = F.when(~any_null([key]), F.col("__last"))
    labelled = activity_status(
        last, cutoff=cutoff, inactive=inactive, active=active, data_type=data_type
    )
    fields = [F.col(f"__winner.{c}").alias(c) for c in attributes]
    return grouped.select(key, *fields, labelled.alias(status))
