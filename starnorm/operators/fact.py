"""The fact table: surrogates attached, one row per grain key."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame

from starnorm.operators.dedupe import one_row_per_key
from starnorm.operators.lookup import lookup
from starnorm.sizing import BROADCAST_BYTES, fits
from starnorm.staging import staged


@dataclass(frozen=True)
class Attach:
    """A natural-keyed dimension whose surrogate the fact receives.

    ``row_count`` and ``small`` pass on what is known of it; see :func:`lookup`.
    """

    dim: DataFrame
    natural_key: tuple[str, ...]
    id_name: str
    row_count: str | None = None
    small: bool | None = None


def attach_keys(
    flat: DataFrame,
    dims: Sequence[Attach],
    *,
    null_safe: bool = False,
    spread_by: Sequence[str] | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add the surrogate of every dimension to the flat rows.

    With plain equality a natural key with any null part gets no surrogate, even if
    the dimension holds that key; ``null_safe`` matches null with null.

    Dimensions small enough to broadcast come first: where their surrogates replace
    the natural keys, the rows that the large ones shuffle are narrower.
    """
    measured = [
        (attach, _is_small(attach, broadcast_bytes) if attach.small is None else attach.small)
        for attach in dims
    ]
    rows = flat
    for attach, small in sorted(measured, key=lambda pair: not pair[1]):
        rows = lookup(
            rows,
            attach.dim,
            {c: c for c in attach.natural_key},
            {attach.id_name: attach.id_name},
            null_safe=null_safe,
            row_count=attach.row_count,
            small=small,
            source=flat,
            spread_by=spread_by,
            broadcast_bytes=broadcast_bytes,
        )
    return rows.select(*flat.columns, *[attach.id_name for attach in dims])


def _is_small(attach: Attach, limit: int) -> bool:
    return fits(attach.dim.select(attach.id_name, *attach.natural_key), limit)


def build_fact(
    flat: DataFrame,
    dims: Sequence[Attach],
    columns: Sequence[str],
    grain: Sequence[str],
    *,
    null_safe: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Attach surrogates, keep ``columns``, and keep one row per ``grain`` key.

    The surrogates are attached first: once they replace the natural keys the rows
    that the last step shuffles are narrow. Where a dimension is too large to broadcast,
    they are staged before that step, so that the disk does not hold both shuffles of the
    fact at once.
    """
    dims = [
        replace(attach, small=_is_small(attach, broadcast_bytes)) if attach.small is None else attach
        for attach in dims
    ]
    surrogates = {attach.id_name for attach in dims}
    needed = [c for c in columns if c not in surrogates]
    needed += [c for attach in dims for c in attach.natural_key if c not in needed]
    rows = attach_keys(
        flat.select(*dict.fromkeys(needed)),
        dims,
        null_safe=null_safe,
        spread_by=grain,
        broadcast_bytes=broadcast_bytes,
    ).select(*columns)
    if not all(attach.small for attach in dims):
        rows = staged(rows, "attached")
    return one_row_per_key(rows, grain)
