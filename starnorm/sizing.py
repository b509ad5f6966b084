"""Measured table sizes, the condition for every broadcast and every single-file export."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 32 * 1024 * 1024
# One reducer's share of a shuffle.
SHUFFLE_BYTES = 128 * 1024 * 1024

_VARIABLE = (T.StringType, T.BinaryType)
_NESTED = (T.ArrayType, T.MapType, T.StructType, T.VariantType)


def fits(df: DataFrame, limit_bytes: int, *, rows_of: DataFrame | None = None) -> bool:
    """Whether all values of ``df`` together take at most ``limit_bytes``.

    Fixed-width values count eight bytes, text its exact length. The row count
    comes first: on Parquet it is read from the footers, and a large table is
    turned away before any column is touched. ``rows_of`` names a cheaper frame
    known to have as many rows. Nested values have no cheap bound and never fit.
    """
    if limit_bytes <= 0 or any(isinstance(f.dataType, _NESTED) for f in df.schema):
        return False
    fixed = (df if rows_of is None else rows_of).count() * 8 * len(df.columns)
    if fixed > limit_bytes:
        return False
    texts = [f.name for f in df.schema if isinstance(f.dataType, _VARIABLE)]
    if not texts or fixed == 0:
        return True
    lengths = sum(F.coalesce(F.octet_length(F.col(c)), F.lit(0)).cast("long") for c in texts)
    text_bytes = df.agg(F.sum(lengths).alias("bytes")).first()["bytes"]
    return fixed + text_bytes <= limit_bytes


def fit_together(frames: Mapping[str, DataFrame], limit_bytes: int) -> dict[str, bool]:
    """:func:`fits` for each of several small-looking frames, in one job."""

    def size(name: str, df: DataFrame) -> DataFrame:
        texts = [f.name for f in df.schema if isinstance(f.dataType, _VARIABLE)]
        fixed = F.lit(8 * len(df.columns)).cast("long")
        lengths = (F.coalesce(F.octet_length(F.col(c)), F.lit(0)).cast("long") for c in texts)
        total = F.coalesce(F.sum(sum(lengths, fixed)), F.lit(0))
        return df.agg(total.alias("bytes")).select(F.lit(name).alias("name"), "bytes")

    plain = {
        name: df
        for name, df in frames.items()
        if not any(isinstance(f.dataType, _NESTED) for f in df.schema)
    }
    if limit_bytes <= 0 or not plain:
        return dict.fromkeys(frames, False)
    sizes = reduce(DataFrame.unionByName, [size(name, df) for name, df in plain.items()])
    found = {row["name"]: row["bytes"] for row in sizes.collect()}  # a row a frame
    return {name: name in found and found[name] <= limit_bytes for name in frames}


@contextmanager
def sized_shuffles(spark: SparkSession, input_bytes: int) -> Iterator[int]:
    """Shuffle partitions for an input of this size, for what runs inside the block.

    Adaptive execution merges those that turn out small. A larger number of the
    session is left alone; the session has its own again at the end.
    """
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    chosen = max(int(before), -(-input_bytes // SHUFFLE_BYTES))
    spark.conf.set(name, str(chosen))
    try:
        yield chosen
    finally:
        spark.conf.set(name, before)
