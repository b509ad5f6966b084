"""Parquet folders, written in parallel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from starnorm.hadoop import replace_tree
from starnorm.sinks.aside import written_aside
from starnorm.staging import freed_shuffles


def write_parquet(
    df: DataFrame,
    folder: str,
    name: str,
    *,
    partition_by: Sequence[str] = (),
    compression: str | None = None,
) -> str:
    """Write ``<folder>/<name>`` with as many part files as the frame has partitions.

    An earlier table is replaced once the new one is whole; a job that fails leaves it.
    ``df`` may read the table it replaces. ``compression`` (default: the session's) names a
    codec of Parquet.
    """
    target = f"{folder.rstrip('/')}/{name}"
    with written_aside(df.sparkSession, target) as path, freed_shuffles(df.sparkSession):
        df.write.partitionBy(*partition_by).parquet(path, compression=compression)
        replace_tree(df.sparkSession, path, target)
    return target
