"""Readers of flat input and of written stars."""

from starnorm.sources.csv import (
    STAR_TIMESTAMP,
    CheckedRead,
    count_malformed,
    from_rows,
    preview,
    read_checked,
    read_flat,
    read_star_csv,
)
from starnorm.sources.parquet import read_star_parquet

__all__ = [
    "STAR_TIMESTAMP",
    "CheckedRead",
    "count_malformed",
    "from_rows",
    "preview",
    "read_checked",
    "read_flat",
    "read_star_csv",
    "read_star_parquet",
]
