"""Foreign-key checks that return rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starnorm.operators.keys import common_type, in_type
from starnorm.operators.lookup import lookup
from starnorm.sizing import BROADCAST_BYTES
from starnorm.staging import staged


@dataclass(frozen=True)
class FkEdge:
    """``table.fk`` refers to ``dim.dim_key``; ``nullable`` lets it be null."""

    table: str
    fk: str
    dim: str
    dim_key: str
    nullable: bool = False


def _comparable(facts: DataFrame, fk: str, dim: DataFrame, dim_key: str) -> tuple[Column, Column]:
    """Both columns in the type in which plain equality compares them."""
    left, right = facts.schema[fk].dataType, dim.schema[dim_key].dataType
    kind = common_type(left, right)
    return in_type(F.col(fk), left, kind), in_type(F.col(dim_key), right, kind)


def fk_check(
    facts: DataFrame,
    dim: DataFrame,
    fk: str,
    dim_key: str,
    dim_name: str,
    *,
    nullable: bool = True,
) -> DataFrame:
    """One report row: null and unmatched fact rows of a foreign key.

    Unmatched rows are counted, not their distinct keys. A null counts as unmatched
    only where the key may not be null. The fact is reduced to a count per key
    before it meets the dimension, so a hot key is one row per task and the join
    reuses the partitioning of the count.
    """
    fk_value, key_value = _comparable(facts, fk, dim, dim_key)
    counts = facts.groupBy(fk_value.alias("__fk")).agg(
        F.count("*").alias("__rows"), F.count_if(F.col(fk).isNull()).alias("__nulls")
    )
    keys = dim.select(key_value.alias("__key")).distinct()
    joined = counts.join(keys, F.col("__fk") == F.col("__key"), "left")
    # A key that is no value of the other's type is unmatched, but not null.
    counted = F.col("__rows") - F.col("__nulls") if nullable else F.col("__rows")

    def total(rows: Column) -> Column:
        return F.coalesce(F.sum(rows), F.lit(0))

    report = joined.agg(
        total(F.col("__nulls")).alias("null_count"),
        total(F.when(F.col("__key").isNull(), counted)).alias("mismatch_count"),
    )
    return report.select(
        F.lit(dim_name).alias("dim_name"),
        F.lit(fk).alias("fk_col"),
        "null_count",
        "mismatch_count",
        (F.col("mismatch_count") == 0).alias("passed"),
    )


def fk_orphans(
    facts: DataFrame,
    dim: DataFrame,
    fk: str,
    dim_key: str,
    *,
    nullable: bool = True,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The fact rows without a partner; null keys are among them unless ``nullable``."""
    fk_value, key_value = _comparable(facts, fk, dim, dim_key)
    rows = facts.withColumn("__fk", fk_value)
    if nullable:
        rows = rows.filter(F.col(fk).isNotNull())
    keys = dim.select(key_value.alias("__dim_key")).filter(F.col("__dim_key").isNotNull())
    keys = staged(keys.distinct().withColumn("__known", F.lit(True)), "dim-keys")
    found = lookup(
        rows,
        keys,
        {"__fk": "__dim_key"},
        {"__known": "__known"},
        spread_by=facts.columns,
        broadcast_bytes=broadcast_bytes,
    )
    return found.filter(F.col("__known").isNull()).select(*facts.columns)


# Keys of these types are compared as numbers, all others as a text that differs exactly
# where the values do.
_LONG, _TEXT = "__long", "__text"


def _as_entry(column: Column, kind: T.DataType) -> tuple[Column, Column]:
    """A key in the common type as (number, text), one of which is always null."""
    none_long, none_text = F.lit(None).cast("bigint"), F.lit(None).cast("string")
    if isinstance(kind, (T.IntegralType, T.BooleanType)):
        return column.cast("bigint"), none_text
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("bigint"), none_text
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column), none_text
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return none_long, (column + F.lit(0.0)).cast("string")  # one zero
    if isinstance(kind, T.BinaryType):
        return none_long, F.hex(column)
    return none_long, column.cast("string")


_ENTRY = (_LONG, _TEXT, "__rows", "__nulls", "__known")


def _unpivoted(table: DataFrame, entries: Mapping[int, tuple[Column, ...]]) -> DataFrame:
    """A row (edge, number, text, rows, nulls, known) for every row of ``table`` and edge."""
    wide = table.select(
        *[c.alias(f"{name}{i}") for i, entry in entries.items() for name, c in zip(_ENTRY, entry, strict=True)]
    )
    sets = ", ".join(f"({', '.join(f'{n}{i}' for n in _ENTRY)}) AS `{i}`" for i in entries)
    return table.sparkSession.sql(
        f"SELECT CAST(__edge AS INT) AS __edge, {', '.join(_ENTRY)} FROM {{wide}} "
        f"UNPIVOT INCLUDE NULLS (({', '.join(_ENTRY)}) FOR __edge IN ({sets}))",
        wide=wide,
    )


def fk_suite(tables: Mapping[str, DataFrame], edges: Iterable[FkEdge]) -> DataFrame:
    """One report row per edge; every table is read once for all edges that leave it.

    A table becomes (edge, key) pairs, counted with a map-side step, so a hot key leaves
    a task as one row. The keys of a dimension are pairs of every edge that leads to it,
    counted as zero rows. All of them are brought together by one shuffle on edge and
    key: a pair that no dimension gave is unmatched.
    """
    edges = list(edges)
    leaving: dict[str, dict[int, tuple[Column, ...]]] = {}
    entering: dict[str, dict[int, tuple[Column, ...]]] = {}
    for i, e in enumerate(edges):
        left, right = tables[e.table].schema[e.fk].dataType, tables[e.dim].schema[e.dim_key].dataType
        kind = common_type(left, right)
        number, text = _as_entry(in_type(F.col(e.fk), left, kind), kind)
        is_null = F.col(e.fk).isNull().cast("int")
        leaving.setdefault(e.table, {})[i] = (number, text, F.lit(1), is_null, F.lit(False))
        number, text = _as_entry(in_type(F.col(e.dim_key), right, kind), kind)
        # A null key of a dimension is nobody's partner.
        known = number.isNotNull() | text.isNotNull()
        entering.setdefault(e.dim, {})[i] = (number, text, F.lit(0), F.lit(0), known)
    parts = [
        _unpivoted(tables[table], entries)
        for pairs in (leaving, entering)
        for table, entries in pairs.items()
    ]
    counts = (
        reduce(DataFrame.unionByName, parts)
        .groupBy("__edge", _LONG, _TEXT)
        .agg(
            F.sum("__rows").alias("__rows"),
            F.sum("__nulls").alias("__nulls"),
            F.max("__known").alias("__known"),
        )
    )
    spark = counts.sparkSession
    described = F.array(
        *[
            F.struct(
                F.lit(e.table).alias("table_name"),
                F.lit(e.dim).alias("dim_name"),
                F.lit(e.fk).alias("fk_col"),
                F.lit(e.nullable).alias("nullable"),
            )
            for e in edges
        ]
    )
    # Edges of empty tables have a report, too.
    zero = F.lit(0).cast("bigint")
    every = spark.range(len(edges)).select(
        F.col("id").cast("int").alias("__edge"),
        zero.alias("__rows"),
        zero.alias("__nulls"),
        F.lit(True).alias("__known"),
    )
    unmatched = F.when(~F.col("__known"), F.col("__rows")).otherwise(0)
    # A key that is no value of the other's type is unmatched, but not null.
    unmatched_nulls = F.when(~F.col("__known"), F.col("__nulls")).otherwise(0)
    totals = (
        counts.select("__edge", "__rows", "__nulls", "__known")
        .unionByName(every)
        .groupBy("__edge")
        .agg(
            F.sum("__nulls").alias("null_count"),
            F.sum(unmatched).alias("__unmatched"),
            F.sum(unmatched_nulls).alias("__unmatched_nulls"),
        )
        .withColumn("__e", F.element_at(described, F.col("__edge") + 1))
    )
    allowed = F.when(F.col("__e.nullable"), F.col("__unmatched_nulls")).otherwise(0)
    return totals.withColumn("mismatch_count", F.col("__unmatched") - allowed).select(
        "__e.table_name",
        "__e.dim_name",
        "__e.fk_col",
        "null_count",
        "mismatch_count",
        (F.col("mismatch_count") == 0).alias("passed"),
    )
