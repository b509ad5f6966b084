"""What a star consists of, as plain data."""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass

from starnorm.functions.activity import ACTIVE, CUTOFF, INACTIVE
from starnorm.operators.integrity import FkEdge
from starnorm.operators.star_join import JoinEdge


@dataclass(frozen=True)
class KeyedDim:
    """A dimension that brings its own key."""

    name: str
    key: str
    attributes: tuple[str, ...]
    order_by: tuple[str, ...] = ()
    keep: str = "first"
    drop_all_null: bool = False
    drop_null_key: bool = False

    @property
    def sources(self) -> tuple[str, ...]:
        """The flat columns this dimension reads."""
        return (self.key, *self.attributes, *self.order_by)


@dataclass(frozen=True)
class StatusDim:
    """A keyed dimension with a status from its latest activity."""

    name: str
    key: str
    attributes: tuple[str, ...]
    ts: str
    status: str
    cutoff: str = CUTOFF
    inactive: str = INACTIVE
    active: str = ACTIVE

    @property
    def sources(self) -> tuple[str, ...]:
        return (self.key, *self.attributes, self.ts)


@dataclass(frozen=True)
class NaturalDim:
    """A dimension of distinct attribute combinations under a generated key."""

    name: str
    id_name: str
    natural_key: tuple[str, ...]
    drop_all_null: bool = False

    @property
    def sources(self) -> tuple[str, ...]:
        return self.natural_key


@dataclass(frozen=True)
class FactSpec:
    """Columns of the fact in order: surrogates by name, all others from the input."""

    name: str
    grain: tuple[str, ...]
    columns: tuple[str, ...]
    null_safe: bool = False


@dataclass(frozen=True)
class StarSpec:
    dims: tuple[KeyedDim | StatusDim | NaturalDim, ...]
    fact: FactSpec
    fk_edges: tuple[FkEdge, ...] = ()
    join_edges: tuple[JoinEdge, ...] = ()

    @property
    def tables(self) -> tuple[str, ...]:
        return (*[dim.name for dim in self.dims], self.fact.name)

    def dims_for(self, tables: Collection[str]) -> list[KeyedDim | StatusDim | NaturalDim]:
        """The dimensions to build for ``tables``: the fact brings those it numbers."""
        fact = self.fact.columns if self.fact.name in tables else ()
        return [d for d in self.dims if d.name in tables or getattr(d, "id_name", None) in fact]

    def sources(self, tables: Collection[str] | None = None) -> list[str]:
        """The flat columns ``tables`` (default: all) are made from, each once."""
        tables = self.tables if tables is None else tables
        names = [c for dim in self.dims_for(tables) for c in dim.sources]
        if self.fact.name in tables:
            numbered = {d.id_name for d in self.dims if isinstance(d, NaturalDim)}
            names += [c for c in self.fact.columns if c not in numbered]
        return list(dict.fromkeys(names))
