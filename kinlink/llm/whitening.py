"""Operator 13, embedding whitening by principal components.

Components of a vector are quantised to integers.  The fit list holds each
distinct quantised vector once; its size and the sums of every dimension
are exact.  A second pass centres each vector before it is multiplied and
adds up one covariance matrix a task; the tasks' entries are summed in
Spark.  The matrix (dimension by dimension, whatever the number of rows) is
then made tridiagonal by Householder reflections, its leading eigenvalues
are found by bisection on Sturm counts, and their eigenvectors by inverse
iteration, vectors of close eigenvalues being orthogonalised against each
other in every step.  A third pass whitens the fit list and measures how far
its covariance is from the identity; the last one projects every row on the
components, which travel with the task.

What the driver holds is bounded by the dimension: sums, one triangle of the
covariance, the components.  Copies of a vector meet in a partial
aggregation, so a vector that makes up a third of all rows is one row a
task.  The fit list is a table in the folder that ``spark.checkpoint.dir``
names.

Defined results: vectors that are null or hold a null, NaN or infinite entry
are dropped.  Shorter vectors count as padded with zeros, so an empty one is
all zeros.  Rows with a null id stay, with a null id; repeated ids and
repeated vectors are rows of their own and get equal values.  Directions
without variance (below ``1e-12`` of the trace) cannot be whitened and give no
component, so an empty table, one distinct vector or none gives no rows.
Components of equal variance come in some order, the same for all rows.  A
deviation that exceeds 64 bits is null.  Other columns are ignored, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import ship

SCALE = 256
#: Eigenvalues below this share of the trace are rounding, not variance.
NO_VARIANCE = 1e-12
#: Eigenvalues closer than this share of the matrix norm form a cluster.
CLUSTER = 1e-3
OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


# -------------------------------------------------------- eigenvectors --
def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, subdiagonal and Householder vectors of a symmetric matrix."""
    a = np.array(matrix, float)
    n = len(a)
    reflectors = []
    for k in range(n - 2):
        v = a[k + 1:, k].copy()
        long = np.linalg.norm(v)
        if long > 0:
            side = -np.copysign(long, v[0])
            v[0] -= side
            v /= np.linalg.norm(v)
            rest = a[k + 1:, k + 1:]
            p = rest @ v
            w = p - (v @ p) * v
            rest -= 2 * (np.outer(v, w) + np.outer(w, v))
            a[k + 1, k] = side
        reflectors.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflectors


def sturm_count(diagonal: np.ndarray, below: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each value of ``at``, how many eigenvalues lie below it."""
    tiny = np.finfo(float).tiny
    count = np.zeros(len(at), int)
    q = np.ones(len(at))
    for i, d in enumerate(diagonal):
        q = d - at - (below[i - 1] ** 2 / q if i else 0)
        q = np.where(np.abs(q) < tiny, -tiny, q)
        count += q < 0
    return count


def leading_values(diagonal: np.ndarray, below: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, each bisected to the last bit."""
    n = len(diagonal)
    around = np.abs(np.concatenate([[0], below])) + np.abs(np.concatenate([below, [0]]))
    low, high = np.full(k, (diagonal - around).min()), np.full(k, (diagonal + around).max())
    high += np.finfo(float).eps * np.maximum(np.abs(low), np.abs(high)) + np.finfo(float).tiny
    rank = n - 1 - np.arange(k)             # eigenvalues below the wanted one
    while True:
        middle = low + (high - low) / 2
        open_ = (middle > low) & (middle < high)
        if not open_.any():
            return middle
        more = sturm_count(diagonal, below, middle) > rank
        high = np.where(open_ & more, middle, high)
        low = np.where(open_ & ~more, middle, low)


def _shifted_solver(diagonal: np.ndarray, below: np.ndarray, value: float, least: float):
    """``solve(b)`` of (T - value) x = b, by elimination with row exchanges."""
    n = len(diagonal)
    d, u, w = (diagonal - value).tolist(), [*below.tolist(), 0.0], [0.0] * n     # diagonal, first and second above it
    steps = []
    for i in range(n - 1):
        lower = float(below[i])
        swap = abs(lower) > abs(d[i])
        if swap:
            factor = d[i] / lower
            d[i], u[i], w[i], d[i + 1], u[i + 1] = lower, d[i + 1], u[i + 1], u[i] - factor * d[i + 1], -factor * u[i + 1]
        else:
            d[i] = d[i] if abs(d[i]) > least else least
            factor = lower / d[i]
            d[i + 1] -= factor * u[i]
        steps.append((swap, factor))
    d[-1] = d[-1] if abs(d[-1]) > least else least

    def solve(b: np.ndarray) -> np.ndarray:
        x = b.tolist()
        for i, (swap, factor) in enumerate(steps):
            if swap:
                x[i], x[i + 1] = x[i + 1], x[i]
            x[i + 1] -= factor * x[i]
        for i in range(n - 1, -1, -1):
            x[i] = (x[i] - (u[i] * x[i + 1] if i + 1 < n else 0) - (w[i] * x[i + 2] if i + 2 < n else 0)) / d[i]
        return np.array(x)

    return solve


def leading_components(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` leading eigenvalues of a symmetric matrix, falling, and unit eigenvectors as rows.

    ArithmeticError if a vector fails its equation by more than rounding.
    """
    n = len(matrix)
    size = float(np.abs(matrix).max(initial=0))
    if not n or not size:
        return np.zeros(0), np.zeros((0, n))
    diagonal, below, reflectors = tridiagonal(matrix / size)
    values = leading_values(diagonal, below, min(k, n))
    norm = max(1.0, float((np.abs(diagonal) + np.abs(np.append(below, 0))).max()))
    eps = np.finfo(float).eps
    vectors, start, shift, first = [], np.random.default_rng(13), np.inf, 0
    for j, value in enumerate(values):
        if j and values[j - 1] - value > CLUSTER * norm:
            first = j                       # a new cluster
        shift = min(float(value), shift - 10 * eps * norm) if j > first else float(value)
        solve = _shifted_solver(diagonal, below, shift, eps * norm)
        x = start.uniform(-1, 1, n)
        for _ in range(5):
            x = solve(x / np.linalg.norm(x))
            for _ in range(2):
                for other in vectors[first:]:
                    x -= (other @ x) * other
        vectors.append(x / np.linalg.norm(x))
    back = np.array(vectors)
    for i in range(len(reflectors) - 1, -1, -1):
        v = reflectors[i]
        back[:, i + 1:] -= 2 * np.outer(back[:, i + 1:] @ v, v)
    back /= np.linalg.norm(back, axis=1, keepdims=True)
    off = np.abs(back @ (matrix / size) - values[:, None] * back).max()
    if not off < 1e-9 * norm * max(1, n):
        raise ArithmeticError(f"an eigenvector misses its equation by {off}")
    return values * size, back


# ------------------------------------------------------------- passes --
def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id, x`` of the rows that take part, unpadded."""
    bad = F.exists("embedding", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
            .filter(F.col("embedding").isNotNull() & ~bad)
            .select("vec_id", F.transform("embedding", lambda c: F.floor(c * F.lit(float(scale)))).alias("x")))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.values.to_numpy(zero_copy_only=False)[column.offsets[0].as_py():column.offsets[-1].as_py()]
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def _sums(width: int):
    """A task's exact sums, one row a dimension, and its row count as dimension -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * width
        for batch in batches:
            x = _matrix(batch.column(0), width)
            safe = np.abs(x.astype(float)).max(initial=0) < 2 ** 40
            part = x.sum(axis=0) if safe else x.astype(object).sum(axis=0)
            n, total = n + len(x), [t + int(p) for t, p in zip(total, part)]
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, width), pa.int32()),
                                          pa.array([Decimal(n), *map(Decimal, total)], pa.decimal128(38, 0))], names=["i", "total"])

    return run


def _products(width: int, mean: np.ndarray, onto: np.ndarray | None = None):
    """A task's sums of products of centred vectors (projected ``onto`` directions), lower triangle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = width if onto is None else len(onto)
        total = np.zeros((size, size))
        for batch in batches:
            centred = _matrix(batch.column(0), width) - mean
            if onto is not None:
                centred = centred @ onto.T
            total += centred.T @ centred
        i, j = np.tril_indices(size)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], names=["i", "j", "total"])

    return run


def _covariance(fit: DataFrame, n: int, size: int, run) -> np.ndarray:
    out = np.zeros((size, size))
    for i, j, total in fit.mapInArrow(run, "i int, j int, total double").groupBy("i", "j").agg(F.sum("total")).collect():
        out[i, j] = out[j, i] = total / n
    return out


def _project(n: int, sums: list[int], onto: np.ndarray, explained: np.ndarray, error: float):
    """Rows of every component: exact deviation, whitened value."""
    width, k = len(sums), len(onto)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean = np.array([s / n for s in sums])
        for batch in batches:
            x = _matrix(batch.column(1), width)
            reach = n * np.abs(x.astype(float)).max(initial=0) + max(map(abs, sums))
            if width * reach ** 2 < 2.0 ** 62:
                deviation = ((n * x - np.array(sums, np.int64)) ** 2).sum(axis=1).tolist()
            else:
                deviation = [d if d < 2 ** 63 else None for d in ((n * x.astype(object) - np.array(sums, object)) ** 2).sum(axis=1)]
            white = (x - mean) @ onto.T
            rows = len(x)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(np.repeat(np.arange(rows), k))),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                pa.array(np.full(rows * k, n, np.int64)),
                pa.array(deviation, pa.int64()).take(pa.array(np.repeat(np.arange(rows), k))),
                pa.array(white.ravel()),
                pa.array(np.tile(explained, rows)),
                pa.array(np.full(rows * k, error))],
                names=[c.split()[0] for c in OUT.split(", ")])

    return run


def whiten(vectors: DataFrame, components: int = 4, scale: int = SCALE) -> DataFrame:
    """For each row and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``."""
    spark = vectors.sparkSession
    ship(spark)
    nothing = spark.createDataFrame([], OUT)
    rows = quantised(vectors, scale)
    width = rows.agg(F.max(F.size("x"))).first()[0] or 0
    padded = F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("x")))
    fit, _ = materialize(rows.select(padded.alias("x")).distinct(), "fit")
    found = dict(fit.mapInArrow(_sums(width), "i int, total decimal(38,0)").groupBy("i").agg(F.sum("total")).collect())
    n, sums = int(found.get(-1, 0)), [int(found.get(i, 0)) for i in range(width)]
    if not n or not width:
        return nothing
    mean = np.array([s / n for s in sums])
    covariance = _covariance(fit, n, width, _products(width, mean))
    trace = float(np.trace(covariance))
    values, vectors_ = leading_components(covariance, components)
    sure = values > NO_VARIANCE * trace
    values, vectors_ = values[sure], vectors_[sure]
    if not len(values):
        return nothing
    onto = vectors_ / np.sqrt(values)[:, None]
    white = _covariance(fit, n, len(onto), _products(width, mean, onto))
    error = float(np.abs(white - np.eye(len(onto))).max())
    return rows.mapInArrow(_project(n, sums, onto, values / trace, error), OUT)
