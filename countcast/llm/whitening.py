"""Whitening of embeddings: pivoted Cholesky of the centred scatter, one-sided Jacobi on its triangular factor."""

import sys
from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countcast.llm.common import stored

#: A component of an embedding becomes ``floor(SCALE * c)``.
SCALE = 256
#: Whole numbers below this are exact in double precision.
EXACT = 1 << 53
MOST_SWEEPS = 60

# Tasks get this module's functions by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = ("vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, "
          "eigenvalue double")


def whole_vectors(vectors: DataFrame, *keep: str) -> DataFrame:
    """The ``keep`` columns and ``x``, the scaled whole-number vector, of rows whose embedding is neither NULL nor holds a NULL
    or non-finite component."""
    finite = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return (
        vectors.select(*keep, "embedding").filter(F.col("embedding").isNotNull() & finite)
        .select(*keep, F.transform("embedding", lambda c: F.floor(c.cast("double") * SCALE).cast("long")).alias("x"))
    )


def one_length(vectors: DataFrame, column: str) -> int:
    """The length that all vectors of ``column`` share; 0 without rows, ValueError with several."""
    sizes = vectors.agg(F.min(F.size(column)).alias("low"), F.max(F.size(column)).alias("high")).first()
    if sizes["low"] != sizes["high"]:
        raise ValueError(f"vectors of different lengths: {sizes['low']} to {sizes['high']}")
    return sizes["low"] or 0


def as_matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def shifted(x: np.ndarray, centre: list[int]) -> np.ndarray:
    """``x - centre``, as Python integers where 64 bits could overflow."""
    if max([0, int(x.max(initial=0)), -int(x.min(initial=0)), *map(abs, centre)]) >= 1 << 61:
        return x.astype(object) - np.array(centre, dtype=object)
    return x - np.array(centre, dtype=np.int64)


def exact_products(z: np.ndarray) -> np.ndarray:
    """``z' z`` as Python integers. Blocks whose sums stay below 2^53 are exact in double precision, where products are fast."""
    largest = max(int(z.max(initial=0)), -int(z.min(initial=0)))
    if largest * largest >= EXACT:
        z = z.astype(object)
        return z.T.dot(z)
    step = min(len(z), EXACT // max(1, largest * largest)) or 1
    total = np.zeros((z.shape[1], z.shape[1]), dtype=object)
    for start in range(0, len(z), step):
        part = z[start:start + step].astype(np.float64)
        total += (part.T @ part).astype(np.int64).astype(object)
    return total


def _summed(vectors: DataFrame, add: Callable[[np.ndarray], np.ndarray], dims: int) -> list[int]:
    """Sums of whole-number arrays that ``add`` makes of each batch of vectors: one array per task, added place by place."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = add(as_matrix(batch.column(0), dims))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(total)), pa.int32()), pa.array([Decimal(int(t)) for t in total], pa.decimal128(38, 0))],
                names=["place", "total"])

    sums = vectors.select("x").mapInArrow(partial, "place int, total decimal(38,0)").groupBy("place").agg(F.sum("total").alias("total"))
    return [int(r["total"]) for r in sorted(sums.collect(), key=lambda r: r["place"])]


def pivoted_cholesky(matrix: np.ndarray) -> np.ndarray:
    """``G`` with ``G G' = matrix`` (positive semidefinite), triangular but for the order of its rows; a column for each
    pivot above rounding, so as many as the rank."""
    rest = matrix.copy()
    size = len(matrix)
    least = size * np.finfo(float).eps * max(rest.diagonal().max(initial=0.0), 0.0)
    columns = []
    for _ in range(size):
        pivot = int(np.argmax(rest.diagonal()))
        if rest[pivot, pivot] <= least:
            break
        column = rest[:, pivot] / np.sqrt(rest[pivot, pivot])
        rest -= np.outer(column, column)
        rest[pivot, :] = rest[:, pivot] = 0.0
        columns.append(column)
    return np.array(columns).reshape(-1, size).T


def jacobi(factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (as columns) of ``factor factor'``.

    Pairs of columns are rotated until all are orthogonal; then squared norms are the eigenvalues and the normalised columns the
    eigenvectors. Each round rotates disjoint pairs at once, as in a tournament in which every column meets every other.
    """
    g = factor.copy()
    n = g.shape[1]
    seats = np.arange(n + n % 2)
    small = np.finfo(float).eps * np.sqrt(max(1, len(g)))
    for _ in range(MOST_SWEEPS):
        turned = False
        for _ in range(len(seats) - 1):
            pairs = np.sort(np.stack([seats[:len(seats) // 2], seats[len(seats) // 2:][::-1]]), axis=0)
            i, j = pairs[:, pairs[1] < n]
            a, b = (g[:, i] ** 2).sum(axis=0), (g[:, j] ** 2).sum(axis=0)
            c = (g[:, i] * g[:, j]).sum(axis=0)
            at = np.abs(c) > small * np.sqrt(a * b)
            if at.any():
                turned = True
                i, j, a, b, c = i[at], j[at], a[at], b[at], c[at]
                zeta = (b - a) / (2 * c)
                t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
                cos = 1 / np.hypot(1.0, t)
                left, right = g[:, i], g[:, j]
                g[:, i], g[:, j] = cos * left - cos * t * right, cos * t * left + cos * right
            seats = np.concatenate([seats[:1], seats[-1:], seats[1:-1]])
        if not turned:
            break
    else:
        raise RuntimeError(f"columns are not orthogonal after {MOST_SWEEPS} sweeps")
    norms = np.sqrt((g ** 2).sum(axis=0))
    order = np.argsort(-norms, kind="stable")
    return norms[order] ** 2, g[:, order] / norms[order]


def whiten(vectors: DataFrame, n_components: int = 4) -> DataFrame:
    """Whitened coordinates of each usable row: ``vec_id, component, n, deviation, whitened, explained, identity_error,
    eigenvalue``, one row per vector and component.

    ``vectors`` has ``vec_id`` and ``embedding``; other columns are ignored. Rows with a NULL embedding or a NULL or non-finite
    component go; the rest become whole numbers ``x``. Mean and covariance are those of the distinct ``x``, each once, which
    Spark thins out on the map side, so a vector that fills a third of the table is one row there. Their scatter is summed exactly:
    vectors are centred at the mean's nearest whole numbers before they are multiplied, and the rest of the mean (half a unit at most)
    is taken off in exact arithmetic. Only sums of ``dims`` and ``dims * dims`` numbers reach the driver, whatever the rows.

    Components whose eigenvalue is zero within rounding have no whitened coordinate and are left out, so equal vectors alone, a
    single vector, or empty vectors give no rows, nor does an empty table. A row without id keeps its NULL. ``deviation`` is NULL where
    the exact number exceeds a long. Vectors of different lengths raise ValueError.
    """
    rows = whole_vectors(vectors, "vec_id")
    fit = stored(rows.select("x").distinct(), "whitening-fit")
    dims = one_length(fit, "x")
    n = fit.count()
    if not dims:
        return vectors.sparkSession.createDataFrame([], SCHEMA)
    total = _summed(fit, lambda x: _column_sums(x), dims)
    centre = [round(t / n) if abs(t) < EXACT else t // n for t in total]
    rest = [t - n * c for t, c in zip(total, centre)]

    upper = np.triu_indices(dims)
    products = _summed(fit, lambda x: exact_products(shifted(x, centre))[upper], dims)
    covariance = np.zeros((dims, dims))
    covariance[upper] = [(n * p - rest[i] * rest[j]) / (n * n) for p, i, j in zip(products, *upper)]
    covariance = covariance + np.triu(covariance, 1).T
    values, axes = jacobi(pivoted_cholesky(covariance))
    k = min(n_components, len(values))
    if not k:
        return vectors.sparkSession.createDataFrame([], SCHEMA)
    directions = axes[:, :k] / np.sqrt(values[:k])
    shift = np.array([r / n for r in rest])
    explained = (values[:k] / np.trace(covariance)).tolist()

    def coordinates(x: np.ndarray) -> np.ndarray:
        return (shifted(x, centre).astype(np.float64) - shift) @ directions

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k + 1))
        for batch in batches:
            w = coordinates(as_matrix(batch.column(0), dims))
            w = np.column_stack([np.ones(len(w)), w])
            total += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array(range(total.size), pa.int32()), pa.array(total.ravel())], names=["place", "total"])

    parts = fit.select("x").mapInArrow(moments, "place int, total double").groupBy("place").agg(F.sum("total").alias("total")).collect()
    moment = np.array([r["total"] for r in sorted(parts, key=lambda r: r["place"])]).reshape(k + 1, k + 1) / n
    spread = moment[1:, 1:] - np.outer(moment[0, 1:], moment[0, 1:])
    error = float(np.abs(spread - np.eye(k)).max())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = as_matrix(batch.column(1), dims)
            ids = batch.column(0).take(pa.array(np.repeat(np.arange(len(x)), k)))
            far = deviations(shifted(x, centre), n, rest)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array([n] * (k * len(x)), pa.int64()),
                 pa.array([f for f in far for _ in range(k)], pa.int64()), pa.array(coordinates(x).ravel()),
                 pa.array(explained * len(x), pa.float64()), pa.array([error] * (k * len(x)), pa.float64()),
                 pa.array(values[:k].tolist() * len(x), pa.float64())],
                schema=_ARROW)

    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), "x").mapInArrow(project, SCHEMA)


_ARROW = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()),
                    ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64()), ("eigenvalue", pa.float64())])


def _column_sums(x: np.ndarray) -> np.ndarray:
    largest = max(int(x.max(initial=0)), -int(x.min(initial=0)))
    return (x.astype(object) if largest * len(x) >= 1 << 62 else x).sum(axis=0).astype(object)


def deviations(z: np.ndarray, n: int, rest: list[int]) -> list[int | None]:
    """Sums over dimensions of ``(n z - rest)^2``, exact; None above a long."""
    largest = max(int(z.max(initial=0)), -int(z.min(initial=0))) * n + max(map(abs, rest))
    if z.shape[1] * largest * largest < 1 << 63:
        return ((z * n - np.array(rest)) ** 2).sum(axis=1).tolist()
    exact = ((z.astype(object) * n - np.array(rest, dtype=object)) ** 2).sum(axis=1)
    return [int(e) if e < 1 << 63 else None for e in exact]
