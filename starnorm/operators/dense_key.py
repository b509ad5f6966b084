"""Dense surrogate keys without moving the keys through one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starnorm.staging import staged

# monotonically_increasing_id keeps the partition number above the low 33 bits.
_PARTITION_SHIFT = 33


def dense_key(keys: DataFrame, order_by: Sequence[str], id_name: str) -> DataFrame:
    """Number distinct keys 0..N-1 in key order, nulls first.

    ``keys`` holds one row per value of ``order_by``; further columns are carried.
    """
    numbered = dense_keys(keys, (), order_by, "__id")
    return numbered.select(F.col("__id").alias(id_name), *keys.columns)


def dense_keys(
    keys: DataFrame, sets: Sequence[str], order_by: Sequence[str], id_name: str
) -> DataFrame:
    """Number the keys of each of several sets 0..N-1 in key order, nulls first.

    ``sets`` names the columns that tell the sets apart; there may be none, and all keys
    are one set. A global sort range-partitions the keys on the set and all key columns,
    every partition numbers its own rows, and the numbered rows are staged so that the
    numbering cannot change on a re-run. The counts per partition and set, at most one
    row per partition of the sort but for the sets that meet there, then give each
    partition its start. Which range a key fell into does not show in the result.
    """
    order = [F.col(c).asc_nulls_first() for c in (*sets, *order_by)]
    place = F.monotonically_increasing_id()
    placed = staged(keys.orderBy(*order).withColumn("__place", place), "dense-key")
    run = F.shiftright("__place", _PARTITION_SHIFT)
    runs = placed.groupBy(*sets, run.alias("__run")).agg(
        F.count("*").alias("__size"), F.min("__place").alias("__head")
    )
    earlier = Window.partitionBy(*sets).orderBy("__run")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("__size").over(earlier), F.lit(0))
    marks = [F.col(c).alias(f"__set{i}") for i, c in enumerate(sets)]
    shifts = runs.select(
        *marks, F.col("__run").alias("__of"), (start - F.col("__head")).alias("__shift")
    )
    same = run == F.col("__of")
    for i, c in enumerate(sets):
        same &= F.col(c).eqNullSafe(F.col(f"__set{i}"))
    numbered = placed.join(F.broadcast(shifts), same)
    return numbered.select((F.col("__place") + F.col("__shift")).alias(id_name), *keys.columns)
