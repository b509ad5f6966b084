"""Parts of a timestamp, as 64-bit integers or full English names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hour_of_day(ts: Column) -> Column:
    """0 to 23."""
    return F.hour(ts).cast("bigint")


def weekday_name(ts: Column) -> Column:
    """Full name, such as Monday."""
    return F.date_format(ts, "EEEE")


def weekday_number(ts: Column) -> Column:
    """1 for Sunday to 7 for Saturday, so that a caller can sort the names."""
    return F.dayofweek(ts).cast("bigint")


def year_of(ts: Column) -> Column:
    return F.year(ts).cast("bigint")
