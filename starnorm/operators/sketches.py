"""Distinct counts by mergeable sketches: stored with a table, merged on a later run.

A sketch is a few kilobytes, whatever it has seen. Sketches of parts of a table, or of
groups of its rows, merge into the sketch of the whole without a look at the rows: a
load of today's rows is sketched alone and merged with what earlier loads stored.

Values enter by a 64-bit hash, so every type with a hash may be sketched.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Binary logarithm of a sketch's counters.
LG_K = 12
# Partial sketches are merged in so many groups of partitions before they are merged into one.
GROUPS = 256


def relative_error(lg_k: int = LG_K) -> float:
    """Standard error of a merged sketch's estimate, as a part of the count."""
    return 1.04 / (1 << lg_k) ** 0.5


def hashed(df: DataFrame, name: str) -> Column:
    """A column's values as they enter a sketch; null enters none."""
    kind, column = df.schema[name].dataType, F.col(name)
    if isinstance(kind, (T.MapType, T.VariantType)):
        raise ValueError(f"{name}: values of type {kind.simpleString()} have no hash")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        column = column + F.lit(0.0)  # one zero
    return F.when(F.col(name).isNotNull(), F.xxhash64(column))


def column_sketches(
    df: DataFrame, columns: Sequence[str] | None = None, lg_k: int = LG_K
) -> DataFrame:
    """(column_name, n_rows, n_null, sketch) per column, for :func:`merged` and :func:`estimated`.

    One scan; what leaves a task is one sketch a column. They are merged in groups of
    partitions first, so that no task merges those of all partitions.
    """
    names = list(columns or df.columns)
    taken = [f"__{part}{i}" for i in range(len(names)) for part in ("s", "z")]
    rows = df.select(
        *[hashed(df, c).alias(f"__h{i}") for i, c in enumerate(names)],
        F.pmod(F.spark_partition_id(), F.lit(GROUPS)).alias("__group"),
    )
    partial = [F.count(F.lit(1)).alias("__n")]
    whole = [F.sum("__n").alias("__n")]
    for i in range(len(names)):
        partial.append(F.hll_sketch_agg(f"__h{i}", F.lit(lg_k)).alias(f"__s{i}"))
        partial.append(F.count_if(F.col(f"__h{i}").isNull()).alias(f"__z{i}"))
        whole.append(F.hll_union_agg(f"__s{i}").alias(f"__s{i}"))
        whole.append(F.sum(f"__z{i}").alias(f"__z{i}"))
    sketched = rows.groupBy("__group").agg(*partial).agg(*whole).select("__n", *taken)
    entries = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.coalesce("__n", F.lit(0)).alias("n_rows"),
            F.coalesce(f"__z{i}", F.lit(0)).alias("n_null"),
            F.col(f"__s{i}").alias("sketch"),
        )
        for i, name in enumerate(names)
    ]
    return sketched.select(F.inline(F.array(*entries)))


def merged(first: DataFrame, *further: DataFrame) -> DataFrame:
    """The sketches of several parts of a table as those of the whole."""
    parts = reduce(DataFrame.unionByName, further, first)
    return parts.groupBy("column_name").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_null").alias("n_null"),
        F.hll_union_agg("sketch").alias("sketch"),
    )


def estimated(sketches: DataFrame) -> DataFrame:
    """(column_name, n_distinct, n_null): null counts as one value."""
    values = F.coalesce(F.hll_sketch_estimate("sketch"), F.lit(0))
    return sketches.select(
        "column_name",
        (values + (F.col("n_null") > 0).cast("bigint")).alias("n_distinct"),
        "n_null",
    )


def group_sketches(
    facts: DataFrame, by: Sequence[Column | str], counted: str, lg_k: int = LG_K
) -> DataFrame:
    """(by..., n_rows, sketch): rows with a ``counted`` value and its distinct values, per group."""
    rows = facts.withColumn("__hash", hashed(facts, counted))
    return rows.groupBy(*by).agg(
        F.count(counted).alias("n_rows"), F.hll_sketch_agg("__hash", F.lit(lg_k)).alias("sketch")
    )


def rolled_up(sketches: DataFrame, by: Sequence[Column | str], name: str = "n_distinct") -> DataFrame:
    """Group sketches by fewer columns: (by..., n_rows, ``name``), never counting a value twice."""
    return (
        sketches.groupBy(*by)
        .agg(F.sum("n_rows").alias("n_rows"), F.hll_union_agg("sketch").alias("__sketch"))
        .withColumn(name, F.hll_sketch_estimate("__sketch"))
        .drop("__sketch")
    )
