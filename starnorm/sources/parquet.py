"""Parquet folders of a written star."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def read_star_parquet(
    spark: SparkSession, folder: str, names: Iterable[str]
) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{folder}/{name}") for name in names}
