"""Embedding whitening by shifted CholeskyQR.

The centred rows A are never gathered: every pass sums Q'Q over all rows, Q = A R^-1 being solved row by
row from the triangular factor so far, and the Cholesky factor of that small matrix, shifted where it is
near singular, is multiplied into R. When Q is orthonormal, A = Q R, and the singular value decomposition
of R gives the principal directions of A without ever squaring its condition.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partledger.llm.common import stored

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
MAX_PASSES = 8
ORTHONORMAL = 1e-8    # distance from the identity at which passes stop; what is left is taken into R
NOTHING = 1e-10       # a direction with less than this share of the largest singular value has no variance
EXACT = 1 << 53       # entries beyond it are no whole numbers of steps any more
ROWS = 4096           # vectors multiplied at once
LONG = (1 << 63) - 1


@dataclass(frozen=True)
class Whitening:
    """n vectors with sums S; rows of ``axes`` are unit components by falling ``variance``."""

    n: int
    sums: np.ndarray
    axes: np.ndarray
    variance: np.ndarray
    total: float
    passes: int

    def __call__(self, deviation: np.ndarray) -> np.ndarray:
        """Whitened rows of exact deviations n * x - S."""
        return deviation / self.n @ self.axes.T / np.sqrt(self.variance)


def steps(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """``id, x``: vectors as whole steps. Null vectors, empty ones and those with null, non-finite or huge
    entries go; of several lengths the commonest stays, ties to the longer."""
    v = F.col("v")
    sound = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c * SCALE) < EXACT))
    kept = rows.select(F.col(vec_id).alias("id"), F.col(vector).cast("array<double>").alias("v")).where(
        v.isNotNull() & (F.size("v") > 0) & F.coalesce(sound, F.lit(False)))
    x = stored(kept.select("id", F.transform("v", lambda c: F.floor(c * SCALE) + OFFSET).alias("x")), "steps")
    lengths = x.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    common = lengths.orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    return x.where(F.size("x") == (common[0].d if common else 0))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, d)


def _blocks(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[np.ndarray]:
    """The vectors of a partition, about ``ROWS`` together."""
    held, n = [], 0
    for batch in batches:
        held.append(_matrix(batch.column(0), d))
        n += len(held[-1])
        if n >= ROWS:
            yield np.concatenate(held)
            held, n = [], 0
    if n:
        yield np.concatenate(held)


def _totals(x: DataFrame, d: int) -> tuple[int, np.ndarray]:
    """Number of vectors and exact sum of each dimension."""
    def run(batches):
        n, sums = 0, np.zeros(d, np.int64)
        for block in _blocks(batches, d):
            n += len(block)
            sums += block.sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(d + 1, dtype=np.int32)), pa.array(np.append(sums, n))], ["i", "s"])

    found = x.select("x").mapInArrow(run, "i int, s long").groupBy("i").agg(F.sum("s").alias("s")).orderBy("i").collect()
    values = np.array([r.s for r in found], np.int64)
    return (int(values[-1]), values[:-1]) if len(values) else (0, np.zeros(d, np.int64))


def _gram(x: DataFrame, n: int, sums: np.ndarray, size: int, rows_of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum of q q' over all rows q: each partition adds up its own, one row of the matrix is added up in one
    task from one row of every partition, and the driver gets the matrix."""
    d = len(sums)

    def run(batches):
        total = np.zeros((size, size))
        for block in _blocks(batches, d):
            q = rows_of((n * block - sums).astype(np.float64))
            total += q.T @ q
        i, j = np.triu_indices(size)
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])],
                                             ["i", "j", "s"])

    out = np.zeros((size, size))
    for r in x.select("x").mapInArrow(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).toLocalIterator():
        out[r.i, r.j] = out[r.j, r.i] = r.s
    return out


def _factor(gram: np.ndarray, n: int) -> np.ndarray:
    """Upper Cholesky factor, of the matrix plus a shift where it is near singular. The shift is the bound
    on the rounding of a Gram matrix of n rows, and grows until the factor exists."""
    d = len(gram)
    values = np.linalg.eigvalsh(gram)
    shift = 0.0 if values[0] > 1e-3 * values[-1] else min(1e-4, 11 * (n * d + d * (d + 1)) * 2.0 ** -53) * values[-1]
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(d)).T
        except np.linalg.LinAlgError:
            shift = max(shift * 100, 1e-12 * values[-1])


def _solved(rows: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """Rows times the inverse of each factor in turn, by triangular substitution."""
    for r in factors:
        q = np.empty_like(rows)
        for j in range(len(r)):
            q[:, j] = (rows[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
        rows = q
    return rows


def fit(x: DataFrame, n: int, sums: np.ndarray, components: int = COMPONENTS) -> Whitening | None:
    """Principal components of n vectors with the given sums; None where there are none or none varies."""
    if not n:
        return None
    d = len(sums)
    factors, r, total = [], np.eye(d), None
    while True:
        gram = _gram(x, n, sums, d, lambda a, f=list(factors): _solved(a / n, f))
        total = float(np.trace(gram)) / n if total is None else total
        if total == 0:
            return None
        if np.abs(gram - np.eye(d)).max() < ORTHONORMAL or len(factors) == MAX_PASSES:
            break
        factors.append(_factor(gram, n))
        r = factors[-1] @ r
        # A direction that the rows do not have is noise in Q, and no further pass makes it orthonormal.
        singular = np.linalg.svd(r, compute_uv=False)
        if len(factors) >= 4 and singular[-1] < NOTHING * singular[0]:
            gram = _gram(x, n, sums, d, lambda a, f=list(factors): _solved(a / n, f))
            break
    values, vectors = np.linalg.eigh(gram)
    _, sigma, axes = np.linalg.svd((vectors * np.sqrt(np.maximum(values, 0))).T @ r)
    kept = min(components, int((sigma > NOTHING * sigma[0]).sum()))
    return Whitening(n, sums, np.ascontiguousarray(axes[:kept]), sigma[:kept] ** 2 / n, total, len(factors))


def whiten(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``vec_id, n, deviation, explained, identity_error, whitened`` for every sound vector.

    Each entry becomes floor(64 * entry) + 1,000,000. ``whitened`` holds one value a component, by falling
    variance, and ``explained`` the components' shares of all variance. ``deviation`` is the sum of
    (n * x - S)^2, exact, and null where it does not fit a long. ``identity_error`` is the
    largest entry of the covariance of ``whitened`` less the identity, measured over all rows.

    Vectors that are null, empty or hold null, non-finite or huge entries (2^53 steps) are dropped, and of
    several lengths all but the commonest (ties: the longest). Repeated rows count as often as they are there;
    a null id is kept. A direction without variance is no component, so equal vectors, a single one
    among them, give empty arrays. An empty table gives no rows. Texts play no part; other columns are not read.
    """
    spark, kind = rows.sparkSession, rows.schema[vec_id].dataType.simpleString()
    x = steps(rows, vec_id, vector)
    first = x.first()
    d = len(first.x) if first else 0
    n, sums = _totals(x, d)
    model = fit(x, n, sums, components)
    axes = 0 if model is None else len(model.axes)
    error, explained = 0.0, []
    if model is not None:
        error = float(np.abs(_gram(x, n, sums, axes, model) / n - np.eye(axes)).max())
        explained = (model.variance / model.total).tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = n * _matrix(batch.column(1), d) - sums
            if d * float(np.abs(far).max(initial=0)) ** 2 < LONG / 2:
                squares = (far * far).sum(axis=1).tolist()
            else:
                squares = [s if s <= LONG else None for s in (sum(int(v) ** 2 for v in row) for row in far)]
            white = model(far.astype(np.float64)) if model is not None else np.zeros((len(far), 0))
            offsets = pa.array(np.arange(len(far) + 1, dtype=np.int32) * axes)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(squares, pa.int64()), pa.ListArray.from_arrays(
                offsets, pa.array(white.ravel()))], ["vec_id", "deviation", "whitened"])

    out = x.mapInArrow(run, f"vec_id {kind}, deviation long, whitened array<double>")
    shares = F.array(*[F.lit(float(e)) for e in explained]).cast("array<double>")
    return out.select("vec_id", F.lit(n).cast("long").alias("n"), "deviation", shares.alias("explained"),
                      F.lit(error).alias("identity_error"), "whitened")
