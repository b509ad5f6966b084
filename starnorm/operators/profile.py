"""Distinct values and nulls of every column, counted or estimated."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starnorm.operators.sketches import LG_K, column_sketches, estimated


def _grouped_as(kind: T.DataType, name: str) -> T.DataType:
    """The type in which a column's values are grouped; it tells the same values apart."""
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        raise ValueError(f"{name}: nested values are not profiled")
    if isinstance(kind, T.IntegralType):
        return T.LongType()
    if isinstance(kind, T.FloatType):
        return T.DoubleType()
    return T.StringType() if isinstance(kind, T.NullType) else kind


def column_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: distinct values, null counting as one, and null rows.

    Columns of one type become (column, value) pairs in that type, no value being turned
    into text. Pairs are counted with a map-side step and dealt out by their hash, so a
    task counts the distinct values of its share of every column; the shares are summed.
    Each type is one scan of its own columns: over stored tables each column is read
    once, and frames that are dear to compute should be stored first.
    """
    names = list(columns or df.columns)
    by_type: dict[T.DataType, list[int]] = {}
    for i, name in enumerate(names):
        by_type.setdefault(_grouped_as(df.schema[name].dataType, name), []).append(i)
    counts = []
    for kind, places in by_type.items():
        values = [F.col(names[i]).cast(kind).alias(str(i)) for i in places]
        pairs = df.select(*values).unpivot([], [str(i) for i in places], "column", "value")
        # A pair moves with as little as it can: a short column, and a count of nulls alone.
        pairs = pairs.withColumn("column", F.col("column").cast("int"))
        counted = pairs.groupBy("column", "value").agg(
            F.count_if(F.col("value").isNull()).alias("nulls")
        )
        counts.append(
            counted.groupBy("column").agg(
                F.count(F.lit(1)).alias("n_distinct"), F.sum("nulls").alias("n_null")
            )
        )
    # A column of no rows has a row, too.
    zero = F.lit(0).cast("bigint")
    every = df.sparkSession.range(len(names)).select(
        F.col("id").cast("int").alias("column"), zero.alias("n_distinct"), zero.alias("n_null")
    )
    name = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("column") + 1)
    return (
        reduce(DataFrame.unionByName, counts, every)
        .groupBy("column")
        .agg(F.sum("n_distinct").alias("n_distinct"), F.sum("n_null").alias("n_null"))
        .select(name.alias("column_name"), "n_distinct", "n_null")
    )


def profile_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    """:func:`column_profile` of every table, with its name."""
    profiles = [
        column_profile(df).select(F.lit(name).alias("table_name"), "*")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, profiles)


def approximate_profile(
    df: DataFrame, columns: Sequence[str] | None = None, lg_k: int = LG_K
) -> DataFrame:
    """As :func:`column_profile` with estimated distinct counts and no shuffle of values."""
    return estimated(column_sketches(df, columns, lg_k))
