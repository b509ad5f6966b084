"""One row per key, chosen by a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def one_row_per_key(
    df: DataFrame,
    key: Sequence[str],
    *,
    order_by: Sequence[str] = (),
    keep: str = "first",
) -> DataFrame:
    """Keep the first (or last) row of every key, nulls sorting lowest.

    Rows are ordered by ``order_by``, then by all other columns in frame order, so
    ties are identical rows and the result is a pure function of the data. A null
    key is a key like any other.

    Catalyst turns the filter on the row number into a limit per key on both sides
    of the shuffle: a key holding a third of all rows leaves each task as one row.
    """
    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first' or 'last'")
    lead = [c for c in order_by if c not in key]
    rest = lead + [c for c in df.columns if c not in key and c not in lead]
    if not rest:
        return df.distinct()
    ranks = [F.col(c).asc_nulls_first() if keep == "first" else F.col(c).desc_nulls_last()
             for c in rest]
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*ranks))
    return df.withColumn("__rank", rank).filter(F.col("__rank") == 1).drop("__rank")
