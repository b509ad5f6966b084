"""Flat records to the tables of a star."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import ExitStack
from contextvars import copy_context

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starnorm.hadoop import stored_bytes
from starnorm.operators.dimensions import (
    Numbered,
    keyed_dim,
    natural_dim,
    natural_dims,
    status_dim,
)
from starnorm.operators.fact import Attach, build_fact
from starnorm.plans.spec import KeyedDim, NaturalDim, StarSpec, StatusDim
from starnorm.sizing import BROADCAST_BYTES, fit_together, sized_shuffles
from starnorm.staging import lasting, scratch, write_staged

ROW_COUNT = "__rows"
Dim = KeyedDim | StatusDim | NaturalDim


def _lazy(df: DataFrame, _name: str) -> DataFrame:
    return df


def build_dimension(flat: DataFrame, dim: Dim) -> DataFrame:
    """One dimension; a natural-keyed one also carries its source rows per key."""
    if isinstance(dim, NaturalDim):
        return natural_dim(
            flat,
            dim.natural_key,
            dim.id_name,
            drop_all_null=dim.drop_all_null,
            row_count=ROW_COUNT,
        )
    if isinstance(dim, StatusDim):
        return status_dim(
            flat,
            dim.key,
            dim.attributes,
            dim.ts,
            status=dim.status,
            cutoff=dim.cutoff,
            inactive=dim.inactive,
            active=dim.active,
        )
    return keyed_dim(
        flat,
        dim.key,
        dim.attributes,
        order_by=dim.order_by,
        keep=dim.keep,
        drop_all_null=dim.drop_all_null,
        drop_null_key=dim.drop_null_key,
    )


def normalize(
    flat: DataFrame,
    spec: StarSpec,
    *,
    only: Collection[str] | None = None,
    keep: Callable[[DataFrame, str], DataFrame] = _lazy,
    stage_input: bool = False,
    derived: Mapping[str, str] | None = None,
    side_by_side: int = 8,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> dict[str, DataFrame]:
    """The dimensions of ``spec`` in order, then the fact.

    ``only`` names the tables to build; no other is computed, but for the dimensions
    that number keys of the fact, and no other column of ``flat`` is read or staged.

    ``keep`` makes a finished table durable and returns the frame to go on with:
    :func:`starnorm.staging.staged`, or a sink and a read. What was staged on the way
    is then deleted. By default tables stay lazy, but for the surrogate numbering,
    which is always staged, and the rows of a fact with a dimension too large to broadcast.
    ``stage_input`` turns row-oriented input into Parquet
    first, so that every dimension reads its own columns only, and sizes the shuffles
    by it.

    ``derived`` has the input columns of ``spec`` as SQL expressions over ``flat``, one value
    from one row, the same on every run. What is staged then is ``flat`` as it is, and each
    table computes the columns it reads.

    All natural-keyed dimensions are found by one scan and one shuffle; see
    :func:`natural_dims`. The others do not depend on one another; up to ``side_by_side``
    are submitted at a time, and the fact as soon as its surrogates are there, so the
    tail of one job leaves no executor idle.
    """
    names = spec.tables if only is None else only
    unknown = set(names) - set(spec.tables)
    if unknown:
        raise ValueError(f"no table named {', '.join(sorted(unknown))}")
    spark = flat.sparkSession
    sources = spec.sources(names)
    if derived is None:
        flat = flat.select(*sources)
    with ExitStack() as stack:
        if keep is not _lazy:
            stack.enter_context(scratch(spark))
        if stage_input:
            path = write_staged(flat, "flat")
            stack.enter_context(sized_shuffles(spark, stored_bytes(spark, path)))
            flat = spark.read.schema(flat.schema).parquet(path)
        if derived is not None:
            flat = flat.select(*[F.expr(derived[c]).alias(c) for c in sources])
        return _build(flat, spec, names, keep, side_by_side, broadcast_bytes)


def _build(
    flat: DataFrame,
    spec: StarSpec,
    names: Collection[str],
    keep: Callable[[DataFrame, str], DataFrame],
    side_by_side: int,
    broadcast_bytes: int,
) -> dict[str, DataFrame]:
    def kept(table: DataFrame, name: str) -> DataFrame:
        with lasting():
            return keep(table, name)

    with_fact = spec.fact.name in names
    dims = spec.dims_for(names)
    natural = [dim for dim in dims if isinstance(dim, NaturalDim)]

    def number() -> dict[str, DataFrame]:
        keys = {d.name: Numbered(d.natural_key, d.id_name, d.drop_all_null) for d in natural}
        return natural_dims(flat, keys, ROW_COUNT)

    def finish(dim: Dim) -> DataFrame:
        return kept(build_dimension(flat, dim), dim.name)

    def side_job(pool: ThreadPoolExecutor, function: Callable, *args):
        run = inheritable_thread_target(flat.sparkSession)(function)
        return pool.submit(copy_context().run, run, *args)

    with ThreadPoolExecutor(max_workers=side_by_side) as pool:
        # The fact waits for the surrogates only.
        numbering = side_job(pool, number)
        jobs = {d.name: side_job(pool, finish, d) for d in dims if d not in natural}
        built = numbering.result()
        for dim in natural:
            if dim.name in names:
                table = built[dim.name].drop(ROW_COUNT)
                jobs[dim.name] = side_job(pool, kept, table, dim.name)
        if with_fact:
            numbered = [d for d in natural if d.id_name in spec.fact.columns]
            small = fit_together(
                {d.name: built[d.name].drop(ROW_COUNT) for d in numbered}, broadcast_bytes
            )
            fact = build_fact(
                flat,
                [
                    Attach(built[d.name], d.natural_key, d.id_name, ROW_COUNT, small[d.name])
                    for d in numbered
                ],
                spec.fact.columns,
                spec.fact.grain,
                null_safe=spec.fact.null_safe,
                broadcast_bytes=broadcast_bytes,
            )
            fact = kept(fact, spec.fact.name)
        tables = {dim.name: jobs[dim.name].result() for dim in dims if dim.name in names}
    return {**tables, spec.fact.name: fact} if with_fact else tables
