"""Status of a key from its latest activity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The cutoff (inclusive, midnight) and the two labels.
CUTOFF = "2021-12-31 00:00:00"
INACTIVE = "Inactive"
ACTIVE = "Active"


def as_timestamp(column: Column, data_type: T.DataType) -> Column:
    """Text and dates become timestamps; timestamps keep their own kind.

    Text that is no timestamp becomes null.
    """
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return column
    return column.try_cast("timestamp")


def activity_status(
    last: Column,
    *,
    cutoff: str = CUTOFF,
    inactive: str = INACTIVE,
    active: str = ACTIVE,
    data_type: T.DataType | None = None,
) -> Column:
    """``inactive`` up to and including the cutoff, else ``active``; null is ``active``."""
    kind = "timestamp_ntz" if isinstance(data_type, T.TimestampNTZType) else "timestamp"
    return F.when(last <= F.lit(cutoff).cast(kind), F.lit(inactive)).otherwise(F.lit(active))
