"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation of the centred rows.

Each step makes two distributed products over the centred rows: Xv, reorthogonalised against all earlier left vectors, and
then X'u, reorthogonalised against all earlier right vectors. A left vector is as long as the table, so it is never stored:
it is kept as the short vector w of which it is the image Xw. What reaches the driver are sums as long as a vector is wide.
The singular values of the small bidiagonal matrix give the deviations, its right singular vectors the components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import finite, floored, stage

EXHAUST = 256  # up to so many dimensions the bidiagonalisation runs to its end, and repeated deviations are all found
TOLERANCE = 1e-14  # of the largest deviation: convergence in wider vectors, and what counts as zero
DIRECT = 64  # tasks whose partial sums go straight to the driver; more are summed by a few tasks first
SEED = 13
SAFE = float(1 << 62)


@dataclass(frozen=True)
class Whitening:
    """``n`` fitted vectors, their exact ``sums``, unit ``components`` (rows), their ``values`` (variances) and the ``trace``."""

    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    trace: float


def centred(points: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """Rows less their mean S/n, as (n * x - S) / n: exact up to the one division where that fits a long."""
    most = float(np.abs(points.astype(float)).max(initial=0)) * n + max((abs(float(s)) for s in sums), default=0.0)
    if most < SAFE:
        return (points * n - np.array(sums, np.int64)) / n
    return points.astype(float) - np.array([float(Decimal(s) / n) for s in sums])


def deviations(points: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sum over the dimensions of (n * x - S) ** 2 per row; NULL where it exceeds a long."""
    rough = ((points.astype(float) * n - np.array([float(s) for s in sums])) ** 2).sum(axis=1)
    most = float(np.abs(points.astype(float)).max(initial=0)) * n + max((abs(float(s)) for s in sums), default=0.0)
    if most < 2.0**31 and rough.max(initial=0) < SAFE:
        return ((points * n - np.array(sums, np.int64)) ** 2).sum(axis=1).tolist()
    exact = lambda row: sum((n * x - s) ** 2 for x, s in zip(row.tolist(), sums, strict=True))
    found = (exact(row) if r < 2.0**63 * 1.01 else None for row, r in zip(points, rough, strict=True))
    return [None if d is None or d >= 1 << 63 else d for d in found]


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), dims)


class Rows:
    """Centred rows of a staged table of distinct integer vectors, and sums over them."""

    def __init__(self, fitted: DataFrame, n: int, sums: list[int]):
        self.fitted, self.n, self.sums = fitted, n, sums
        self.tasks = fitted.rdd.getNumPartitions() if n else 0

    def total(self, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """The sum of ``part`` (a vector) over all rows: per task first, then over tasks."""
        n, sums = self.n, self.sums

        def added(parts: Iterator[np.ndarray]) -> pa.RecordBatch:
            whole = sum(parts, 0.0)
            return pa.record_batch([pa.array([whole.tolist() if np.ndim(whole) else []], pa.list_(pa.float64()))], names=["part"])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield added(part(centred(matrix(b.column("x"), len(sums)), n, sums)) for b in batches if len(b))

        def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield added(np.array(p) for b in batches for p in b.column("part").to_pylist() if p)

        parts = self.fitted.select("x").mapInArrow(run, "part array<double>")
        if self.tasks > DIRECT:
            parts = parts.repartition(8).mapInArrow(join, "part array<double>")
        return sum(np.array(r.part) for r in parts.collect() if r.part)


def fresh(rng: np.random.Generator, right: np.ndarray, dims: int) -> np.ndarray:
    """A random unit vector orthogonal to the rows of ``right``."""
    v = rng.standard_normal(dims)
    for _ in range(3):
        v -= right.T @ (right @ v)
        v /= np.linalg.norm(v)
    return v


def bidiagonalise(rows: Rows, dims: int, scale: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Right vectors V (rows) and the upper bidiagonal B with X V' = U B, U having orthonormal columns.

    Where a step's remainder is zero an invariant subspace is complete, and the next right vector is drawn anew.
    """
    rng = np.random.default_rng(SEED)
    right, left = np.zeros((0, dims)), np.zeros((0, dims))
    alpha, beta = [], []
    v, zero = fresh(rng, right, dims), TOLERANCE * scale
    while True:
        right = np.vstack([right, v])
        w = v - (beta[-1] * left[-1] if beta else 0)
        for _ in range(2):
            # Xw and its share in every earlier left vector, in one pass.
            known = left

            def shares(x: np.ndarray, w=w, known=known) -> np.ndarray:
                u = x @ w
                return np.append((x @ known.T).T @ u, u @ u)

            *share, square = rows.total(shares)
            share = np.array(share)
            w = w - known.T @ share if len(known) else w
            if float(share @ share) <= 1e-4 * square:
                break
        a = float(np.sqrt(max(square - float(share @ share), 0.0)))
        if a <= zero:  # X v lies within the earlier left vectors; its own part is zero
            a, w, remainder = 0.0, np.zeros(dims), np.zeros(dims)
        else:
            w = w / a
            remainder = rows.total(lambda x, w=w: (x @ w) @ x) - a * v
            for _ in range(2):
                remainder = remainder - right.T @ (right @ remainder)
        alpha, left = [*alpha, a], np.vstack([left, w])
        b = float(np.linalg.norm(remainder))
        if len(alpha) == dims:
            break
        if dims > EXHAUST and len(alpha) > count:
            p, s, _ = np.linalg.svd(np.diag(alpha) + np.diag(beta, 1))
            if (b * np.abs(p[-1, :count]) <= TOLERANCE * s[0]).all():
                break
        v = remainder / b if b > zero else fresh(rng, right, dims)
        beta.append(b if b > zero else 0.0)
    return right, np.diag(alpha) + np.diag(beta, 1)


def fit(vectors: DataFrame, dims: int, count: int = 4) -> tuple[Whitening, Rows]:
    """Whitening of a frame of integer vectors ``x`` of ``dims`` dimensions; each distinct vector counts once.

    Components without variance are left out, so that there may be fewer than ``count``.
    """
    fitted = stage(vectors.select("x").distinct(), "fit-list")
    n = fitted.count()
    added = fitted.select(F.posexplode("x").alias("at", "c")).groupBy("at").agg(F.sum(F.col("c").cast("decimal(38,0)")).alias("s"))
    sums = [int(r.s) for r in sorted(added.collect(), key=lambda r: r.at)]
    rows = Rows(fitted, n, sums)
    square = float(rows.total(lambda x: np.array([(x * x).sum()]))[0]) if n and dims else 0.0
    if square == 0:
        return Whitening(n, sums, np.zeros((0, dims)), np.zeros(0), 0.0), rows
    right, small = bidiagonalise(rows, dims, float(np.sqrt(square)), count)
    _, sigma, across = np.linalg.svd(small)
    components = (across @ right)[:count]
    components /= np.linalg.norm(components, axis=1, keepdims=True)
    kept = sigma[:count] > 1e-12 * sigma[0]
    return Whitening(n, sums, components[kept], (sigma[:count] ** 2 / n)[kept], square / n), rows


def identity_error(model: Whitening, rows: Rows) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity, centred in a pass before it."""
    if not len(model.values):
        return 0.0
    project = (model.components / np.sqrt(model.values)[:, None]).T
    mean = rows.total(lambda x: (x @ project).sum(axis=0)) / model.n

    def products(x: np.ndarray) -> np.ndarray:
        y = x @ project - mean
        return (y.T @ y).ravel()

    size = len(model.values)
    return float(np.abs(rows.total(products).reshape(size, size) / model.n - np.eye(size)).max())


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", count: int = 4, scale: int = 256) -> DataFrame:
    """Every row and component: ``vec_id`` (the key), component, n, deviation, whitened, explained, identity_error.

    Components become integers floor(scale * c) and are fitted over the distinct vectors. Rows whose vector is NULL or holds a
    NULL or non-finite component are dropped, and so are vectors of another length than the commonest one (of several the
    longest) and empty ones. Rows with a NULL or repeated key are kept. Where fewer than ``count`` directions have any
    variance (few or equal vectors) there are so many components; with none, or an empty table, there are no rows. A
    deviation beyond the range of long is NULL.
    """
    rows = vectors.select(F.col(key).alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    rows = stage(rows.where(finite(F.col("v"))).select("vec_id", floored(F.col("v"), scale).alias("x")), "integers")
    widths = rows.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    dims = widths.dims if widths else 0
    rows = rows.where(F.size("x") == dims)
    model, fitted = fit(rows, dims, count)
    error = identity_error(model, fitted)
    project = (model.components / np.sqrt(model.values)[:, None]).T
    explained = (model.values / model.trace).tolist() if len(model.values) else []
    n, sums, size = model.n, model.sums, len(model.values)
    key_type = rows.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not size or not len(b):
                continue
            points = matrix(b.column("x"), dims)
            own = np.repeat(np.arange(len(b)), size)
            apart = pa.array(deviations(points, n, sums), pa.int64())
            yield pa.record_batch(
                [
                    b.column("vec_id").take(pa.array(own)), pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), len(b))),
                    pa.array(np.full(len(own), n)), apart.take(pa.array(own)), pa.array((centred(points, n, sums) @ project).ravel()),
                    pa.array(np.tile(explained, len(b))), pa.array(np.full(len(own), error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(run, f"vec_id {key_type}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")
