"""What is known of stored tables: rows, and bytes per column.

A table's sizes are recorded while it is staged, as a by-product of the write, or
measured once and remembered for as long as its files stay the same. Joins that must
prove a table small enough to broadcast then run no job of their own.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starnorm.hadoop import stored_version
from starnorm.sizing import BROADCAST_BYTES
from starnorm.staging import write_staged

_VARIABLE = (T.StringType, T.BinaryType)
_NESTED = (T.ArrayType, T.MapType, T.StructType, T.VariantType)


@dataclass(frozen=True)
class TableSizes:
    """Rows; and for columns of text or bytes, all bytes of the column and of its longest value.

    Columns that are not listed have a fixed width of at most eight bytes, but for the
    ``unbounded``, which are nested or were not measured.
    """

    rows: int
    total: Mapping[str, int] = field(default_factory=dict)
    longest: Mapping[str, int] = field(default_factory=dict)
    unbounded: frozenset[str] = frozenset()

    def bound(self, columns: Iterable[str], *, rows: int | None = None) -> int | None:
        """No fewer bytes than the values of ``columns`` take; None if there is no bound.

        With ``rows`` for that many rows, any of them repeated as often as may be.
        """
        size = 0
        for c in columns:
            if c in self.unbounded:
                return None
            if rows is None:
                size += self.total.get(c, 0) + 8 * self.rows
            else:
                size += rows * (self.longest.get(c, 0) + 8)
        return size


def _measures(schema: T.StructType) -> list[Column]:
    out = [F.count(F.lit(1)).alias("rows")]
    for i, f in enumerate(schema):
        if isinstance(f.dataType, _VARIABLE):
            length = F.octet_length(F.col(_quoted(f.name))).cast("long")
            out.append(F.coalesce(F.sum(length), F.lit(0)).alias(f"total{i}"))
            out.append(F.coalesce(F.max(length), F.lit(0)).alias(f"longest{i}"))
    return out


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _sizes(schema: T.StructType, found: Mapping[str, int]) -> TableSizes:
    texts = {f.name: i for i, f in enumerate(schema) if isinstance(f.dataType, _VARIABLE)}
    known = {c: i for c, i in texts.items() if f"total{i}" in found}
    nested = {f.name for f in schema if isinstance(f.dataType, _NESTED)}
    return TableSizes(
        found["rows"],
        {c: found[f"total{i}"] for c, i in known.items()},
        {c: found[f"longest{i}"] for c, i in known.items()},
        frozenset(nested | (texts.keys() - known.keys())),
    )


# By path: the version of the files, and what is known of them.
_KNOWN: dict[str, tuple[tuple, TableSizes]] = {}
_SCHEMAS: dict[str, tuple[tuple, T.StructType]] = {}


def scan(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table; its footers are asked for the schema once per version of its files."""
    version = stored_version(spark, path)
    known = _SCHEMAS.get(path)
    if known is None or known[0] != version:
        frame = spark.read.parquet(path)
        _SCHEMAS[path] = version, frame.schema
        return frame
    return spark.read.schema(known[1]).parquet(path)


def staged_with_sizes(df: DataFrame, label: str = "table") -> tuple[DataFrame, TableSizes]:
    """As :func:`starnorm.staging.staged`, with the sizes counted while writing."""
    spark = df.sparkSession
    observation = Observation()
    path = write_staged(df.observe(observation, *_measures(df.schema)), label)
    sizes = _sizes(df.schema, observation.get)
    _KNOWN[path] = stored_version(spark, path), sizes
    return spark.read.schema(df.schema).parquet(path), sizes


def sizes_of(
    spark: SparkSession, paths: Iterable[str], limit_bytes: int = BROADCAST_BYTES
) -> dict[str, TableSizes]:
    """Sizes of Parquet tables by path.

    Those that are not known, or whose files have changed, are measured together: rows
    in one job, from the footers, and text in another, but for tables that have too many
    rows for ``limit_bytes`` whatever their text is like. Of these text stays unbounded.
    """
    paths = list(paths)
    versions = {path: stored_version(spark, path) for path in paths}
    new = [p for p in paths if p not in _KNOWN or _KNOWN[p][0] != versions[p]]
    if new:
        tables = {p: scan(spark, p) for p in new}
        rows = _collected({p: df.agg(F.count(F.lit(1)).alias("rows")) for p, df in tables.items()})
        small = {p: df for p, df in tables.items() if rows[p]["rows"] * 8 <= limit_bytes}
        texts = {p: df for p, df in small.items() if len(_measures(df.schema)) > 1}
        rows |= _collected({p: df.agg(*_measures(df.schema)) for p, df in texts.items()})
        for p, df in tables.items():
            _KNOWN[p] = versions[p], _sizes(df.schema, rows[p])
    return {p: _KNOWN[p][1] for p in paths}


def _collected(lines: Mapping[str, DataFrame]) -> dict[str, dict[str, int]]:
    """The only row of each frame, all of them in one job."""
    if not lines:
        return {}
    named = [
        df.select(
            F.lit(name).alias("name"),
            F.map_from_arrays(
                F.array(*[F.lit(c) for c in df.columns]),
                F.array(*[F.col(c).cast("long") for c in df.columns]),
            ).alias("found"),
        )
        for name, df in lines.items()
    ]
    return {row["name"]: row["found"] for row in reduce(DataFrame.unionByName, named).collect()}
