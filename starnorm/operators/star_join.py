"""Wide rows out of a star or snowflake of tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starnorm.catalogue import TableSizes
from starnorm.operators.codes import Codes, few_values
from starnorm.operators.lookup import lookup
from starnorm.sizing import BROADCAST_BYTES, fits


@dataclass(frozen=True)
class JoinEdge:
    """Each row of ``table`` has at most one partner in ``to``, by ``column = key``."""

    table: str
    column: str
    to: str
    key: str


def star_join(
    tables: Mapping[str, DataFrame],
    root: str,
    edges: Iterable[JoinEdge],
    columns: Mapping[str, tuple[str, str]],
    *,
    spread_by: Sequence[str] | None = None,
    sizes: Mapping[str, TableSizes] | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Every row of ``root`` with the requested columns of the tables around it.

    ``columns`` maps result names to (table, column). A table is joined only when a
    requested column needs it. Chains are joined from their far end, each at the
    size of its own table, so the root moves at most once per direct edge.
    ``spread_by`` names columns of ``root``, its grain if it has one; see :func:`lookup`.

    ``sizes`` is what is known of the tables, by name. A table that this proves small
    enough to broadcast, with what hangs on it, is not measured: it has as many rows as
    it had before, and each text from further tables is at most the longest there.

    Of a table too large to broadcast, the columns with few different values travel as one
    number, which the last step replaces by them from a broadcast. To find them such a table
    is read several times, so it should be stored.
    """
    sizes = sizes or {}
    edges = list(edges)
    if len({e.to for e in edges}) < len(edges):
        raise ValueError("two edges lead to one table; give it a name per role")

    def wanted(table: str) -> bool:
        own = any(t == table for t, _ in columns.values())
        return own or any(e.table == table and wanted(e.to) for e in edges)

    def proven(table: str, key: str, take: Sequence[str]) -> bool:
        """Whether the sizes say that ``take``, which come with ``table``, are small."""
        if table not in sizes or broadcast_bytes <= 0:
            return False
        rows = sizes[table].rows
        total = sizes[table].bound([key])
        for name in take:
            if name not in columns:  # a number
                total = None if total is None else total + 8 * sizes[table].rows
                continue
            owner, column = columns[name]
            if total is None or owner not in sizes:
                return False
            own = owner == table
            more = sizes[owner].bound([column], rows=None if own else rows)
            total = None if more is None else total + more
        return total is not None and total <= broadcast_bytes

    codes: dict[str, Codes] = {}

    def narrowed(table: str, rows: DataFrame) -> DataFrame:
        """``rows`` of ``table`` with a number for those of its own columns that allow it."""
        own = {name: c for name, (t, c) in columns.items() if t == table}
        values = tables[table].select(*[F.col(c).alias(name) for name, c in own.items()])
        found = few_values(values, f"__code_{table}", broadcast_bytes) if own else None
        if found is None:
            return rows
        codes[found.name] = found
        return found.encode(rows)

    def collect(table: str) -> DataFrame:
        """``table`` with its own and its descendants' requested columns, or their numbers."""
        out = [e for e in edges if e.table == table and wanted(e.to)]
        own = {name: c for name, (t, c) in columns.items() if t == table}
        source = tables[table]
        entry = [e.key for e in edges if e.to == table]
        spread = list(spread_by or ()) if table == root else []
        # Each column once, however many results, links and hashes it serves.
        held = dict.fromkeys([*own.values(), *[e.column for e in out], *entry, *spread])
        rows = source.select(*[F.col(c).alias(f"__{table}_{c}") for c in held])
        before = rows
        steps = []
        for e in out:
            below = collect(e.to)
            take = [c for c in below.columns if c in columns or c in codes]
            needed = below.select(f"__{e.to}_{e.key}", *take)
            small = proven(e.to, e.key, take) or fits(
                needed, broadcast_bytes, rows_of=tables[e.to]
            )
            if not small:
                wide = needed
                needed = narrowed(e.to, wide)
                if needed is not wide:
                    take = [c for c in needed.columns if c in columns or c in codes]
                    small = fits(needed, broadcast_bytes, rows_of=tables[e.to])
            steps.append((e, needed, take, small))
        # Tables too large to broadcast go first, while the rows to shuffle are narrow, and
        # of them those that add least. One found by a column of the grain comes after the
        # others: rows of a grain key then lie together, and what keeps one row of each
        # drops the rest before its shuffle.
        def turn(step: tuple) -> tuple:
            edge, _, take, small = step
            return small, edge.column in spread, len(take)

        for e, below, take, small in sorted(steps, key=turn):
            rows = lookup(
                rows,
                below,
                {f"__{table}_{e.column}": f"__{e.to}_{e.key}"},
                {c: c for c in take},
                small=small,
                source=before,
                spread_by=[f"__{table}_{c}" for c in spread] or None,
                broadcast_bytes=broadcast_bytes,
            )
        taken = [c for *_, take, _ in steps for c in take]
        return rows.select(
            *[F.col(f"__{table}_{c}").alias(name) for name, c in own.items()],
            *[f"__{table}_{c}" for c in entry],
            *taken,
        )

    rows = collect(root)
    for made in codes.values():
        rows = made.decode(rows)
    return rows.select(*columns)
