"""Whitening of vectors along their leading components.

The leading eigenvectors of the covariance V come from subspace iteration with a
Chebyshev filter. V is never formed: one pass over the centred rows X gives
``X'XQ / n`` for a thin block Q, as sums that Spark adds up by place. A filter of degree
m is m such passes in a three-term recurrence; it damps everything between zero and the
least Ritz value of the block, and lets the rest grow. QR and a Rayleigh-Ritz step
follow, until the residuals of the wanted pairs certify them. A block that makes no more
progress is widened; one as wide as the vectors are long needs no filter at all.

What the driver holds is Q, as wide as the wanted components and their guards.

Rows whose vector is null, or has an entry that is null or not finite, are dropped. An
entry c becomes ``floor(1024 c) + 100000``, c being limited so that this stays within
2^40 of 100000. Shorter vectors count as ending in zeros. All other rows count, repeated
ones as often as they occur, whatever their id. Components without variance, beyond
rounding, cannot be whitened and are left out: there are none of a single row, of equal
rows, or of an empty table, which all give no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starnorm.staging import staged

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
LARGEST = float(1 << 40)
# Columns of the block beside the wanted ones, and the most passes in a filter.
GUARDS = 24
DEGREE = 24
# How much more, as a logarithm, a filter may lift the first vector than the last wanted.
SPREAD = 20.0
# Residuals, in parts of the largest eigenvalue: good enough to stop, and to accept
# when they fall no further. Lesser eigenvalues than RANK parts are rounding.
CERTAIN, ACCEPTED, RANK = 1e-14, 1e-13, 1e-12

Pass = Callable[[np.ndarray], np.ndarray]


def entries(vector: Column) -> Column:
    """The vector's entries as whole numbers."""

    def entry(c: Column) -> Column:
        scaled = c.cast("double") * SCALE
        return F.floor(F.greatest(F.least(scaled, F.lit(LARGEST)), F.lit(-LARGEST))) + SHIFT

    return F.transform(vector, entry)


def usable(vector: Column) -> Column:
    """Whether there is a vector and all its entries are finite numbers."""

    def finite(c: Column) -> Column:
        return F.coalesce(F.abs(c.cast("double")) < F.lit(float("inf")), F.lit(False))

    return F.coalesce(F.forall(vector, finite), F.lit(False))


class Rows(NamedTuple):
    """Whole-number rows ``x`` of one length, how many there are, and their exact sums."""

    frame: DataFrame
    n: int
    sums: list[int]

    @property
    def base(self) -> np.ndarray:
        """The whole part of each dimension's mean."""
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rest(self) -> np.ndarray:
        """What the mean has beyond it, times n."""
        return np.array([s % self.n for s in self.sums], np.int64)


def matrix(column: pa.Array) -> np.ndarray:
    """A list column whose lists have one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _summed(frame: DataFrame, term: Pass, shape: tuple[int, int]) -> np.ndarray:
    """The sum of ``term(x)`` over batches of rows: a small matrix from every task."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            if batch.num_rows:
                total += term(matrix(batch["x"]))
        i, j = np.indices(shape, np.int32)
        columns = [pa.array(i.ravel()), pa.array(j.ravel()), pa.array(total.ravel())]
        yield pa.record_batch(columns, ["i", "j", "v"])

    parts = frame.select("x").mapInArrow(partial, "i int, j int, v double")
    out = np.zeros(shape)
    # One row for each place of the matrix, whatever the number of tasks.
    for row in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[row["i"], row["j"]] = row["v"]
    return out


def centred(rows: Rows) -> Pass:
    """A function from whole-number rows to rows less the mean, in doubles."""
    base, rest = rows.base, rows.rest / rows.n
    return lambda x: (x - base).astype(np.float64) - rest


def leading(
    multiply: Pass, size: int, wanted: int, guards: int = GUARDS, degree: int = DEGREE
) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a positive matrix, falling, and unit eigenvectors.

    ``multiply`` is the only access to the matrix.
    """
    rng = np.random.default_rng(13)
    width = min(size, wanted + guards)
    block = np.linalg.qr(rng.normal(size=(size, width)))[0]
    before = np.inf
    while True:
        image = multiply(block)
        inner = block.T @ image
        value, turn = np.linalg.eigh((inner + inner.T) / 2)
        value, turn = value[::-1], turn[:, ::-1]
        block, image = block @ turn, image @ turn
        residual = np.linalg.norm(image - block * value, axis=0)[:wanted].max(initial=0)
        worst = residual / value[0] if value[0] > 0 else 0.0
        if width == size or worst <= CERTAIN or (before / 2 < worst <= ACCEPTED):
            return value[:wanted], block[:, :wanted]
        if before / 2 < worst:
            wider = min(size, 2 * width)
            fresh = rng.normal(size=(size, wider - width))
            block, width, before = np.linalg.qr(np.hstack([block, fresh]))[0], wider, np.inf
            continue
        before = worst
        passes = min(degree, _passes(value, wanted, worst))
        block = np.linalg.qr(_filtered(multiply, block, image, value, passes))[0]


def _passes(value: np.ndarray, wanted: int, worst: float) -> int:
    """The degree that should lift the last wanted vector far enough, but not the first too far.

    A filter lifts a vector by about the exponential of degree times rate.
    """
    half = max(value[-1], value[0] * np.finfo(float).eps) / 2
    first, last = np.arccosh(np.maximum(1.0, (value[[0, wanted - 1]] - half) / half))
    needed = np.log(worst / CERTAIN) / max(last, 1e-3)
    allowed = SPREAD / max(first - last, 1e-3)
    return int(np.ceil(max(2.0, min(needed, allowed, 1e6))))


def _filtered(multiply: Pass, block, image, value, degree: int) -> np.ndarray:
    """A Chebyshev polynomial of the matrix, small from 0 to the least Ritz value.

    Scaled to leave the leading vector about as long as it is.
    """
    half = max(value[-1], value[0] * np.finfo(float).eps) / 2
    sigma = first = half / (value[0] - half)
    last, now = block, (image - half * block) * (sigma / half)
    for _ in range(degree - 1):
        following = 1 / (2 / first - sigma)
        grown = (multiply(now) - half * now) * (2 * following / half)
        last, now, sigma = now, grown - sigma * following * last, following
    return now


def fitted(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding") -> Rows:
    """The usable rows (id, x), written once."""
    raw = vectors.select(F.col(id_col).alias("id"), F.col(vector).alias("vector"))
    kept = staged(
        raw.where(usable(F.col("vector"))).select("id", entries(F.col("vector")).alias("x")), "fit"
    )
    size = kept.agg(
        F.count(F.lit(1)).alias("n"), F.min(F.size("x")).alias("least"), F.max(F.size("x")).alias("most")
    ).first()
    n, most = size["n"], size["most"] or 0
    if n and size["least"] < most:
        ending = F.array_repeat(F.lit(SHIFT).cast("long"), F.lit(most) - F.size("x"))
        kept = kept.withColumn("x", F.concat("x", ending))

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                total = matrix(batch["x"]).sum(axis=0)
                place = pa.array(np.arange(total.size, dtype=np.int32))
                yield pa.record_batch([place, pa.array(total)], ["i", "total"])

    sums = [0] * most
    if most:
        # A batch's sum fits a long; all of them together may not.
        found = kept.select("x").mapInArrow(totals, "i int, total long")
        exact = F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
        for row in found.groupBy("i").agg(exact).collect():
            sums[row["i"]] = int(row["total"])
    return Rows(kept, n, sums)


def deviations(x: np.ndarray, n: int, base: np.ndarray, rest: np.ndarray) -> list[int]:
    """Per row the sum over dimensions of (n x - S)^2, exactly."""
    away = x - base
    if int(np.abs(away).max(initial=0)) * n + n >= 1 << 52 or x.shape[1] > 1024:
        exact = away.astype(object) * n - rest.astype(object)
        return [int(v) for v in (exact * exact).sum(axis=1)]
    away = away * n - rest
    high, low = away >> 26, away & ((1 << 26) - 1)
    parts = [(high * high).sum(axis=1), (high * low).sum(axis=1), (low * low).sum(axis=1)]
    return [(a << 52) + (b << 27) + c for a, b, c in zip(*(p.tolist() for p in parts), strict=True)]


_OUT = "id {id}, n long, deviation decimal(38,0), whitened array<double>"


def whiten(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector: str = "embedding",
    components: int = COMPONENTS,
) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error).

    One row per usable vector and component, numbered from 1 by falling variance.
    ``deviation`` is exact, in 38 digits; a larger one raises.
    """
    spark = vectors.sparkSession
    kind = vectors.select(F.col(id_col)).schema[0].dataType.simpleString()
    rows = fitted(vectors, id_col, vector)
    schema = (
        f"id {kind}, component int, n long, deviation decimal(38,0), whitened double, "
        "explained double, identity_error double"
    )
    size, n = len(rows.sums), rows.n
    if not size or n < 2:
        return spark.createDataFrame([], schema)
    centre = centred(rows)

    def multiply(block: np.ndarray) -> np.ndarray:
        def term(x: np.ndarray) -> np.ndarray:
            own = centre(x)
            return own.T @ (own @ block)

        return _summed(rows.frame, term, block.shape) / n

    trace = _summed(rows.frame, lambda x: (centre(x) ** 2).sum(axis=0)[None, :], (1, size)).sum() / n
    value, axes = leading(multiply, size, min(components, size))
    axes = axes[:, value > RANK * value.max(initial=0)]
    value = value[: axes.shape[1]]
    if not value.size:
        return spark.createDataFrame([], schema)
    project = axes / np.sqrt(value)

    mean = _summed(rows.frame, lambda x: (centre(x) @ project).sum(axis=0)[None, :], (1, value.size)) / n

    def product(x: np.ndarray) -> np.ndarray:
        own = centre(x) @ project - mean
        return own.T @ own

    covariance = _summed(rows.frame, product, (value.size, value.size)) / n
    error = float(np.abs(covariance - np.eye(value.size)).max())
    base, rest = rows.base, rows.rest

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch["x"])
            white = centre(x) @ project
            index = np.arange(0, white.size + 1, value.size, dtype=np.int32)
            yield pa.record_batch(
                [
                    batch["id"],
                    pa.array(np.full(len(x), n)),
                    pa.array(deviations(x, n, base, rest), pa.decimal128(38, 0)),
                    pa.ListArray.from_arrays(pa.array(index), pa.array(white.ravel())),
                ],
                ["id", "n", "deviation", "whitened"],
            )

    shares = F.array(*[F.lit(float(v / trace)) for v in value])
    return (
        rows.frame.mapInArrow(projected, _OUT.format(id=kind))
        .select("id", "n", "deviation", F.posexplode("whitened").alias("place", "whitened"))
        .select(
            "id",
            (F.col("place") + 1).alias("component"),
            "n",
            "deviation",
            "whitened",
            F.element_at(shares, F.col("place") + 1).alias("explained"),
            F.lit(error).alias("identity_error"),
        )
    )
