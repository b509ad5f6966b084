"""Grouped counts, shares and table sizes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starnorm.operators.dedupe import one_row_per_key
from starnorm.operators.keys import common_type, in_type, may_merge
from starnorm.operators.lookup import lookup
from starnorm.sizing import BROADCAST_BYTES
from starnorm.staging import staged


def count_by(
    facts: DataFrame, by: Sequence[Column | str], counted: str, name: str = "n"
) -> DataFrame:
    """Non-null count of ``counted`` per group of fact-side columns."""
    return facts.groupBy(*by).agg(F.count(counted).alias(name))


def count_by_dimension(
    facts: DataFrame,
    dim: DataFrame,
    fk: str,
    dim_key: str,
    dim_columns: Sequence[str],
    counted: str,
    *,
    by: Sequence[Column] = (),
    name: str = "n",
    distinct_name: str | None = None,
    distinct: str | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Non-null count of ``counted`` per group of dimension columns.

    Every fact row counts; one without a partner falls in the null group, and
    dimension rows without facts are absent. ``by`` adds named fact-side columns
    to the grouping. ``distinct_name`` adds the number of distinct non-null values of the
    fact column ``distinct`` (default: the foreign key) per group. Keys of unlike types
    are compared as in :func:`lookup`.

    The fact is counted per foreign key before the join: the join sees one row per
    key and ``by`` however hot the key is. For another ``distinct`` column that is one
    row per key, ``by`` and value; a key that very many values share is spread by the
    lookup, and the groups are reduced per value, which deals a hot group out over its
    values, before the values are counted.
    """
    left, right = facts.schema[fk].dataType, dim.schema[dim_key].dataType
    kind = common_type(left, right)
    named = [c.alias(f"__by{i}") for i, c in enumerate(by)]
    other = distinct_name is not None and distinct not in (None, fk)
    values = [F.col(distinct).alias("__value")] if other else []
    # Text that is no value of the common type is no null key, but has no partner either.
    fk_value = in_type(F.col(fk), left, kind).alias("__fk")
    raw = [F.col(fk).alias("__raw")] if left != kind else []
    per_key = facts.groupBy(fk_value, *raw, *named, *values).agg(F.count(counted).alias("__n"))
    names = [facts.select(c).columns[0] for c in by]
    taken = {f"__d{i}": c for i, c in enumerate(dim_columns)}
    groups = [f"__by{i}" for i in range(len(by))] + list(taken)
    if other:
        joined = lookup(
            staged(per_key, "counted-keys"),
            dim,
            {"__fk": dim_key},
            taken,
            spread_by=["__value", *[f"__by{i}" for i in range(len(by))]],
            broadcast_bytes=broadcast_bytes,
        )
        reduced = joined.groupBy(*groups, "__value").agg(F.sum("__n").alias("__n"))
        aggregates = [F.sum("__n").alias(name), F.count("__value").alias(distinct_name)]
        counts = reduced.groupBy(*groups).agg(*aggregates)
    else:
        key = in_type(F.col(dim_key), right, kind).alias("__key")
        side = dim.select(key, *[F.col(c).alias(n) for n, c in taken.items()])
        if may_merge(right, kind):
            side = one_row_per_key(side.filter(F.col("__key").isNotNull()), ["__key"])
        joined = per_key.join(side, F.col("__fk") == F.col("__key"), "left")
        aggregates = [F.sum("__n").alias(name)]
        if distinct_name:
            # One row per key and group already.
            aggregates.append(F.count("__raw" if raw else "__fk").alias(distinct_name))
        counts = joined.groupBy(*groups).agg(*aggregates)
    finished = [F.col(f"__by{i}").alias(n) for i, n in enumerate(names)]
    finished += [F.col(n).alias(c) for n, c in taken.items()]
    found = [name, *([distinct_name] if distinct_name else [])]
    return counts.select(*finished, *found)


def with_share(grouped: DataFrame, n: str = "n", share: str = "share") -> DataFrame:
    """Add each group's part of the total; null where the total is zero.

    The total is a scalar subquery over the grouped rows, so the groups themselves
    stay where they are.
    """
    total = grouped.agg(F.sum(n)).scalar()
    return grouped.withColumn(share, F.try_divide(F.col(n), total))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table, one row each."""
    sizes = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, sizes)
