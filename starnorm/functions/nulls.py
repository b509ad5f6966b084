"""Null tests over several columns."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def any_null(columns: Iterable[str]) -> Column:
    return reduce(or_, (F.col(c).isNull() for c in columns))


def all_null(columns: Iterable[str]) -> Column:
    return reduce(and_, (F.col(c).isNull() for c in columns))
