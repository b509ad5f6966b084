"""Numbers in place of columns that hold few different values, while their rows move."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starnorm.operators.dense_key import dense_key
from starnorm.operators.lookup import lookup
from starnorm.sizing import fits

# Types whose equal values are the same value: no float, of which -0.0 equals 0.0, and no
# text of a collation. A value that went through its number is the one it was.
_EXACT = (
    T.IntegralType,
    T.BooleanType,
    T.DecimalType,
    T.DateType,
    T.TimestampType,
    T.TimestampNTZType,
)
# Rows for each combination of values, at least: fewer are not worth a number.
ROWS_PER_CODE = 4


@dataclass(frozen=True)
class Codes:
    """The values of ``columns`` that the number ``name`` stands for, a row a number."""

    name: str
    columns: tuple[str, ...]
    values: DataFrame

    def encode(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the number instead of the columns."""
        on = {c: c for c in self.columns}
        coded = lookup(rows, self.values, on, {self.name: self.name}, null_safe=True, small=True)
        return coded.drop(*self.columns)

    def decode(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the columns instead of the number; nulls where that is null."""
        take = {c: c for c in self.columns}
        return lookup(rows, self.values, {self.name: self.name}, take, small=True).drop(self.name)


def few_values(table: DataFrame, name: str, limit_bytes: int) -> Codes | None:
    """Numbers for the columns of ``table`` whose values together fit ``limit_bytes``.

    Columns are taken from the one with the fewest values on, for as long as the estimated
    number of their combinations is small; the size of those found is then measured.
    None if that leaves nothing which a number would make narrower. ``table`` is read three
    times, and only sketches and its distinct values are shuffled.
    """
    usable = [f.name for f in table.schema if _is_exact(f.dataType)]
    texts = [f.name for f in table.schema if f.dataType == T.StringType()]
    if limit_bytes <= 0 or not (texts or len(usable) > 1):
        return None
    lengths = {c: F.coalesce(F.avg(F.octet_length(c)), F.lit(0)).alias(f"length_{c}") for c in texts}
    single = table.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.approx_count_distinct(c).alias(f"values_{c}") for c in usable],
        *lengths.values(),
    ).first()
    usable.sort(key=lambda c: single[f"values_{c}"])
    heads = [usable[: i + 1] for i in range(len(usable))]
    joint = table.agg(*[_combinations(head).alias(f"n{i}") for i, head in enumerate(heads)]).first()
    chosen: Sequence[str] = ()
    for i, head in enumerate(heads):
        width = 8 * (len(head) + 1) + sum(single[f"length_{c}"] for c in head if c in texts)
        few = joint[f"n{i}"] * ROWS_PER_CODE <= single["rows"]
        if few and joint[f"n{i}"] * width <= limit_bytes:
            chosen = head
    if not (len(chosen) > 1 or set(chosen) & set(texts)):
        return None
    kept = tuple(c for c in table.columns if c in chosen)
    values = dense_key(table.select(*kept).distinct(), kept, name)
    return Codes(name, kept, values) if fits(values, limit_bytes) else None


def _is_exact(kind: T.DataType) -> bool:
    return kind == T.StringType() or isinstance(kind, _EXACT)


def _combinations(columns: Sequence[str]) -> Column:
    return F.approx_count_distinct(F.xxhash64(*columns))
