"""Writers of the tables of a star."""

from starnorm.sinks.csv import write_csv
from starnorm.sinks.parquet import write_parquet
from starnorm.sinks.router import FORMATS, write_table

__all__ = ["FORMATS", "write_csv", "write_parquet", "write_table"]
