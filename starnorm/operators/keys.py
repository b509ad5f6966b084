"""Keys of unlike types in one type, so that equal values are equal and hash alike."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import types as T

_STAMPS = (T.DateType, T.TimestampType, T.TimestampNTZType)


def common_type(left: T.DataType, right: T.DataType) -> T.DataType:
    """The type in which plain equality of the two compares; unlike kinds are refused.

    Text is compared with a number as a number, with a date or timestamp as that.
    """
    if left == right:
        return left
    for a, b in ((left, right), (right, left)):
        if isinstance(a, T.StringType):
            if isinstance(b, T.StringType):
                return T.StringType()
            if isinstance(b, T.IntegralType):
                return T.LongType()
            if isinstance(b, T.NumericType):
                return T.DoubleType()
            if isinstance(b, _STAMPS):
                return b
    if isinstance(left, T.IntegralType) and isinstance(right, T.IntegralType):
        return T.LongType()
    if isinstance(left, T.NumericType) and isinstance(right, T.NumericType):
        exact = [_as_decimal(t) for t in (left, right)]
        if all(exact):
            scale = max(t.scale for t in exact)
            whole = max(t.precision - t.scale for t in exact)
            if whole + scale <= 38:
                return T.DecimalType(whole + scale, scale)
        return T.DoubleType()
    if isinstance(left, _STAMPS) and isinstance(right, _STAMPS):
        kinds = (left, right)
        return next((t for t in kinds if isinstance(t, T.TimestampType)), T.TimestampNTZType())
    raise ValueError(f"keys of type {left.simpleString()} and {right.simpleString()} do not compare")


def _as_decimal(kind: T.DataType) -> T.DecimalType | None:
    if isinstance(kind, T.IntegralType):
        return T.DecimalType(20, 0)
    return kind if isinstance(kind, T.DecimalType) else None


def in_type(column: Column, kind: T.DataType, wanted: T.DataType) -> Column:
    """``column`` of type ``kind`` as ``wanted``; text that does not parse is null."""
    if kind == wanted:
        return column
    return column.try_cast(wanted) if isinstance(kind, T.StringType) else column.cast(wanted)


def may_merge(kind: T.DataType, wanted: T.DataType) -> bool:
    """Whether unlike values of one type may become one value in another."""
    if kind == wanted:
        return False
    if isinstance(kind, T.StringType):
        return not isinstance(wanted, T.StringType)  # '1' and '01'
    if isinstance(wanted, T.DoubleType):
        return not isinstance(kind, (T.FloatType, T.ByteType, T.ShortType, T.IntegerType))
    # An hour of local time that a zone skips is another hour there.
    return isinstance(kind, T.TimestampNTZType) and isinstance(wanted, T.TimestampType)
