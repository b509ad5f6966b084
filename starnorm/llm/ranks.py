"""Gapless numbers within groups, whatever the groups' sizes.

A group's rows are dealt into lots by a hash; lots are counted and numbered one after
the other, and rows are numbered inside their lot. No task sees a whole hot group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows in a lot of the largest group.
LOT_ROWS = 50_000


def number_within(
    rows: DataFrame, group: str, order: list[str], name: str, n_rows: int, salt: Column
) -> DataFrame:
    """Add ``name``: 0, 1, ... without gaps in each ``group``.

    ``salt`` deals rows into lots and must tell the rows of a group apart; ``order``
    settles the order in a lot. ``n_rows`` bounds the rows of a group.
    """
    lots = max(1, -(-n_rows // LOT_ROWS))
    dealt = rows.withColumn("_lot", F.pmod(salt, F.lit(lots)).cast("int"))
    sizes = dealt.groupBy(group, "_lot").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(group).orderBy("_lot").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        group, "_lot", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start")
    )
    inside = Window.partitionBy(group, "_lot").orderBy(*order)
    numbered = dealt.withColumn("_place", F.row_number().over(inside) - 1)
    return (
        numbered.join(starts, [group, "_lot"])
        .withColumn(name, (F.col("_start") + F.col("_place")).cast("long"))
        .drop("_lot", "_start", "_place")
    )
