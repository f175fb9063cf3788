"""Embedding whitening: centred covariance by tasks, leading eigenvectors, and a broadcast projection.

The covariance is reduced to a tridiagonal matrix by Householder reflections; bisection on Sturm counts
finds its greatest eigenvalues, inverse iteration their vectors, each made orthogonal to the earlier
ones of its cluster. The matrix has the square of the vectors' length, however many rows there are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import memory
from .tables import written

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
#: entries of this size and beyond are taken for non-finite ones
LARGEST = float(1 << 30)
RESULTS = ("component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_exact")


class Fit(NamedTuple):
    """What rows are projected with: their number, the sums of each dimension, and the components as columns."""

    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    trace: float


def _vectors(batch: pa.RecordBatch, dims: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length of vectors, or for one: the places of the rows that hold usable vectors, and their integers."""
    column = batch["vector"]
    size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten()  # without the entries of null rows
    values = pc.fill_null(flat.cast(pa.float64()), np.nan).to_numpy(zero_copy_only=False)
    ends = np.cumsum(size)
    bad = np.r_[0, np.cumsum(~(np.abs(values) < LARGEST))]
    good = (size > 0) & (bad[ends] == bad[ends - size])
    for d in np.unique(size[good]) if dims is None else [dims]:
        at = np.flatnonzero(good & (size == d))
        if at.size:
            rows = values[(ends[at] - d)[:, None] + np.arange(d)]
            yield at, np.floor(SCALE * rows).astype(np.int64) + SHIFT


def _totals(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[int, list] = {}
    for batch in batches:
        for at, x in _vectors(batch):
            count, sums = found.get(x.shape[1], (0, [0] * x.shape[1]))
            found[x.shape[1]] = [count + at.size, [a + int(b) for a, b in zip(sums, x.sum(axis=0))]]
    for dims, (count, sums) in found.items():
        yield pa.record_batch([pa.array([dims]), pa.array([count]), pa.array([[Decimal(s) for s in sums]], pa.list_(pa.decimal128(38, 0)))], names=["dims", "n", "sums"])


def _scaled(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exactly: in Python's integers where 64 bits do not hold it."""
    wide = n * int(np.abs(x).max(initial=0)) + max((abs(s) for s in sums), default=0) >= 1 << 62
    return x.astype(object) * n - np.array(sums, object) if wide else x * n - np.array(sums, np.int64)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return (_scaled(x, n, sums) / n).astype(np.float64)


def squared_length(y: np.ndarray) -> list[int]:
    """The exact sum of squares of each row of integers."""
    most = int(np.abs(y).max(initial=0))
    if most * most * y.shape[1] < 1 << 63:
        return (y * y).sum(axis=1).tolist()
    if y.dtype == object or most >= 1 << 48 or y.shape[1] >= 1 << 15:
        return [sum(int(v) ** 2 for v in row) for row in y]
    high, low = y >> 24, y & 0xFFFFFF
    return [(int(a) << 48) + (int(b) << 25) + int(c) for a, b, c in zip((high * high).sum(axis=1), (high * low).sum(axis=1), (low * low).sum(axis=1))]


def _products(rows: DataFrame, of: Callable[[pa.RecordBatch], Iterator[np.ndarray]], width: int) -> np.ndarray:
    """The sum over all rows of each row's outer product with itself: a matrix for each task, added up by its rows."""

    def multiply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            for y in of(batch):
                total += y.T @ y
        yield pa.record_batch([pa.array(np.arange(width)), pa.array(list(total))], names=["i", "row"])

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, row in zip(batch["i"].to_pylist(), batch["row"].flatten().to_numpy().reshape(-1, width)):
                sums[i] = sums.get(i, 0) + row
        if sums:
            yield pa.record_batch([pa.array(list(sums)), pa.array(list(sums.values()))], names=["i", "row"])

    found = rows.mapInArrow(multiply, "i long, row array<double>").repartition("i").mapInArrow(add, "i long, row array<double>").toArrow()
    out = np.zeros((width, width))
    out[found["i"].to_numpy()] = found["row"].combine_chunks().flatten().to_numpy().reshape(-1, width)
    return out


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and the unit vectors of the Householder reflections that lead there."""
    a, mirrors = np.array(matrix, float), []
    for k in range(a.shape[0] - 2):
        v = a[k + 1 :, k].copy()
        length = np.linalg.norm(v)
        v[0] += length if v[0] >= 0 else -length
        size = np.linalg.norm(v)
        v = v / size if size > 0 else v
        mirrors.append(v)
        rest = a[k + 1 :, k + 1 :]
        p = rest @ v
        w = 2 * (p - (v @ p) * v)
        rest -= np.outer(v, w) + np.outer(w, v)
        a[k + 1 :, k] -= 2 * v * (v @ a[k + 1 :, k])
    return np.diag(a).copy(), np.diag(a, -1).copy(), mirrors


def sturm_count(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues of the tridiagonal matrix lie below each value."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    q, count = np.ones_like(at), np.zeros(at.shape, np.int64)
    for d, e in zip(diagonal, np.r_[0.0, off]):
        q = d - at - e * e / q
        q = np.where(np.abs(q) < tiny, -tiny, q)
        count += q < 0
    return count


def leading_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k greatest eigenvalues, falling, by bisection down to neighbouring numbers."""
    d = diagonal.size
    radius = np.r_[np.abs(off), 0.0] + np.r_[0.0, np.abs(off)]
    low, high = np.full(k, (diagonal - radius).min()), np.full(k, (diagonal + radius).max())
    reach = np.maximum(np.abs(low), np.abs(high)) * 4 * np.finfo(float).eps
    low, high = low - reach, high + reach
    below = d - 1 - np.arange(k)  # the i-th greatest has so many below it
    for _ in range(200):
        middle = (low + high) / 2
        if np.all((middle <= low) | (middle >= high)):
            break
        over = sturm_count(diagonal, off, middle) > below
        low, high = np.where(over, low, middle), np.where(over, middle, high)
    return (low + high) / 2


def _solve(diagonal: np.ndarray, off: np.ndarray, shift: float, b: np.ndarray) -> np.ndarray:
    """x with (T - shift) x = b, by elimination with row exchanges; pivots of 0 become very small."""
    n, least = diagonal.size, np.finfo(float).eps * max(np.abs(diagonal).max(), np.abs(off).max(initial=0), np.finfo(float).tiny)
    main, upper, second, x = diagonal - shift, np.r_[off, 0.0], np.zeros(n), b.copy()
    for i in range(n - 1):
        if abs(off[i]) > abs(main[i]):
            factor = main[i] / off[i]
            main[i], upper[i], main[i + 1], second[i], upper[i + 1] = off[i], main[i + 1], upper[i] - factor * main[i + 1], upper[i + 1], -factor * upper[i + 1]
            x[i], x[i + 1] = x[i + 1], x[i] - factor * x[i + 1]
        else:
            main[i] = main[i] or least
            factor = off[i] / main[i]
            main[i + 1] -= factor * upper[i]
            x[i + 1] -= factor * x[i]
    for i in range(n - 1, -1, -1):
        pivot = main[i] if abs(main[i]) > least else least
        x[i] = (x[i] - (upper[i] * x[i + 1] if i + 1 < n else 0) - (second[i] * x[i + 2] if i + 2 < n else 0)) / pivot
        if abs(x[i]) > 1e150:  # near an eigenvalue only the direction counts
            scale = 1 / abs(x[i])
            x *= scale
    return x


def leading_vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of the tridiagonal matrix, as columns, by inverse iteration."""
    norm = (np.abs(diagonal) + np.r_[np.abs(off), 0.0] + np.r_[0.0, np.abs(off)]).max()
    found, random, first, shift = np.zeros((diagonal.size, values.size)), np.random.default_rng(7), 0, np.inf
    for j, value in enumerate(values):
        if j and values[j - 1] - value > 1e-3 * norm:
            first = j
        shift = min(value, shift - 4 * np.finfo(float).eps * norm) if j > first else value  # equal values get shifts of their own
        x = random.standard_normal(diagonal.size)
        for _ in range(5):
            x = _solve(diagonal, off, shift, x / np.linalg.norm(x))
            x /= np.abs(x).max()
            for _ in range(2):
                x -= found[:, first:j] @ (found[:, first:j].T @ x)
        found[:, j] = x / np.linalg.norm(x)
    return found


def principal(matrix: np.ndarray, k: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The k greatest eigenvalues of a symmetric matrix and their unit vectors as columns; those that are 0 by rounding are left out."""
    size = np.abs(matrix).max(initial=0)
    if not size:
        return np.zeros(0), np.zeros((matrix.shape[0], 0))
    diagonal, off, mirrors = tridiagonal(matrix / size)
    values = leading_values(diagonal, off, min(k, diagonal.size))
    values = values[values > 4 * diagonal.size * np.finfo(float).eps * values[0]]
    vectors = leading_vectors(diagonal, off, values)
    for i, v in reversed(list(enumerate(mirrors, 1))):
        vectors[i:] -= 2 * np.outer(v, v @ vectors[i:])
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(values.size)])
    return values * size, vectors * signs


def fit(spark: SparkSession, rows: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Fit | None:
    """The components of a column of vectors; None if no row holds a usable vector."""
    column = rows.select(F.col(vector).cast("array<double>").alias("vector"))
    parts = written(spark, column.mapInArrow(_totals, "dims long, n long, sums array<decimal(38,0)>"), "whiten-sums")
    most = parts.groupBy("dims").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("dims")).first()
    if most is None:
        return None
    dims, n = most
    sums = parts.where(F.col("dims") == dims).select(F.posexplode("sums").alias("i", "s")).groupBy("i").agg(F.sum("s").alias("s")).orderBy("i")
    sums = [int(r["s"]) for r in sums.collect()]  # one for each dimension
    matrix = _products(column, lambda batch: (_centred(x, n, sums) for _, x in _vectors(batch, dims)), dims) / n
    matrix = (matrix + matrix.T) / 2
    values, vectors = principal(matrix, components)
    return Fit(n, sums, vectors, values, float(np.trace(matrix)))


def project(spark: SparkSession, rows: DataFrame, key: str, vector: str, model: Fit) -> DataFrame:
    """A row for each usable vector and component; see ``whiten``."""
    dims, width = model.components.shape
    shared = spark.sparkContext.broadcast((model.n, model.sums, model.components / np.sqrt(model.values)))  # dims times components numbers
    column: Column = F.col(vector).cast("array<double>").alias("vector")

    def with_one(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        n, sums, directions = shared.value
        for _, x in _vectors(batch, dims):
            yield np.c_[_centred(x, n, sums) @ directions, np.ones(len(x))]

    moments = _products(rows.select(column), with_one, width + 1) / model.n
    mean = moments[:-1, -1]
    error = float(np.abs(moments[:-1, :-1] - np.outer(mean, mean) - np.eye(width)).max(initial=0))
    explained = model.values / model.trace

    def out(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, directions = shared.value
        for batch in batches:
            for at, x in _vectors(batch, dims):
                lengths = squared_length(_scaled(x, n, sums))
                exact = pa.array([Decimal(v) for v in lengths], pa.decimal128(38, 0))
                lengths = pa.array([v if v < 1 << 63 else None for v in lengths], pa.int64())
                each = pa.array(np.repeat(np.arange(at.size), width))
                whitened = _centred(x, n, sums) @ directions
                columns = [
                    batch["key"].take(pa.array(np.repeat(at, width))), pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), at.size)), pa.array(np.full(len(each), n)), lengths.take(each),
                    pa.array(whitened.ravel()), pa.array(np.tile(explained, at.size)), pa.array(np.full(len(each), error)), exact.take(each),
                ]
                yield pa.record_batch(columns, names=["key", *RESULTS])
        memory.release()

    kind = rows.schema[key].dataType.simpleString()
    done = rows.select(F.col(key).alias("key"), column).mapInArrow(out, f"key {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double, deviation_exact decimal(38,0)")
    return done.withColumnRenamed("key", key)


def whiten(spark: SparkSession, rows: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error, deviation_exact) for each row and component.

    Every entry c becomes the integer x = floor(1024 * c) + 100000. ``deviation`` is the sum over the
    dimensions of (n * x - S) ** 2, exact (null where a long cannot hold it; ``deviation_exact`` has 38
    digits), ``whitened`` the centred vector's coordinate along the component divided by its standard deviation,
    ``explained`` the component's share of the variance, ``identity_error`` the largest difference
    between the covariance of all whitened rows and the identity.

    Rows are dropped whose vector is null or empty, or holds null, non-finite or huge (``LARGEST``) entries;
    of vectors of several lengths the most frequent length stays (of equally frequent ones the greatest).
    Directions without variance are no components, so equal rows alone, like no rows, give none.
    Repeated rows count each; other columns are not read; a key named like a result is an error.
    """
    if key in RESULTS:
        raise ValueError(f"the key may not be called {key}")
    model = fit(spark, rows, vector, components)
    if model is None or not model.values.size:
        kind = rows.schema[key].dataType.simpleString()
        empty = spark.createDataFrame([], f"key {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double, deviation_exact decimal(38,0)")
        return empty.withColumnRenamed("key", key)
    return project(spark, rows, key, vector, model)
