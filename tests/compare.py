"""A Spark result against the same query in DuckDB."""

from __future__ import annotations

import contextlib
import io
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _rows(table) -> list[tuple[str, ...]]:
    columns = [[repr(v) for v in table[c].to_pylist()] for c in sorted(table.column_names)]
    return sorted(zip(*columns, strict=True))


def _types(table) -> dict[str, str]:
    return {f.name: str(f.type).removeprefix("large_") for f in table.schema}


def assert_same(df, connection, sql: str) -> int:
    """Same columns, types and rows in any order; returns the number of rows."""
    expected = connection.sql(sql).to_arrow_table()
    actual = df.toArrow()
    assert _types(actual) == _types(expected)
    assert _rows(actual) == _rows(expected)
    return actual.num_rows


def plan(frame) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        frame.explain()
    return text.getvalue()
