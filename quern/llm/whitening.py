"""Whitening of embeddings: principal components by contour integration over the exact covariance.

An entry ``c`` becomes the whole number ``x = floor(scale * c) + offset``. Sums and, about the whole part of
the mean, sums of products are exact integers, added in each task and then by Spark, so the covariance is
right to the last bit however large the offset is. Its size is that of the dimensions, not of the rows.

Components come from the covariance ``V`` interval by interval:

* Inertia counts: ``V`` is brought to tridiagonal form; the negative pivots of that form less a shift say
  how many eigenvalues lie below the shift. Counts bracket the wanted eigenvalues, and the axis is cut in the
  widest gaps between them, a few eigenvalues to an interval.
* Each interval is a row of a table and is solved in a task: around the interval lies a circle, and a quadrature
  over it of the complex solves ``(z - V) X = Y`` projects a block ``Y`` onto the eigenvectors inside. Rayleigh-
  Ritz on the projected block gives values and vectors; both steps repeat until as many values lie inside as
  the counts say and all residuals are at rounding level. A block that does not get there is widened, up to
  all dimensions, where it is exact.
* A last Rayleigh-Ritz step over the vectors of all intervals makes them orthogonal across the cuts.

Defined results: a vector that is null or holds null or non-finite entries takes no part; an empty vector
takes no part; vectors of several lengths are an error, as is an ``x`` or a deviation beyond 64 bits;
eigenvalues below ``FLOOR`` of the largest count as zero and have no component; no remaining vectors, or
vectors that are all alike, give no rows; equal rows each give their own; eigenvectors of equal eigenvalues are
any orthonormal ones. The largest entry of a component is positive.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 32
#: Part of the largest eigenvalue below which one counts as zero.
FLOOR = 1e-11
#: Eigenvalues of an interval, where gaps allow it.
TOGETHER = 6
#: Points of the quadrature over a half circle.
POINTS = 8
ROUNDS = 40
#: Residual of a finished vector, as a part of the largest eigenvalue and per dimension.
RESIDUAL = 4e-16


# ---------------------------------------------------------------- inertia counts

def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a similar tridiagonal matrix, by Householder reflections."""
    a, n = matrix.astype(np.float64).copy(), len(matrix)
    for k in range(n - 2):
        x = a[k + 1:, k].copy()
        size = np.linalg.norm(x)
        if size == 0:
            continue
        x[0] += np.copysign(size, x[0])
        x /= np.linalg.norm(x)
        block = a[k + 1:, k + 1:]
        p = block @ x
        p -= (p @ x) * x
        block -= 2 * (np.outer(x, p) + np.outer(p, x))
        a[k + 1, k] = a[k, k + 1] = -np.copysign(size, a[k + 1, k])
    return a.diagonal().copy(), a.diagonal(1).copy()


def counts_below(diagonal: np.ndarray, off: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie below each shift: the negative pivots of the shifted matrix."""
    tiny = np.finfo(np.float64).tiny / np.finfo(np.float64).eps
    square = off * off
    pivot = diagonal[0] - shifts
    count = (pivot < 0).astype(np.int64)
    for k in range(1, len(diagonal)):
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        pivot = diagonal[k] - shifts - square[k - 1] / pivot
        count += pivot < 0
    return count


def brackets(diagonal: np.ndarray, off: np.ndarray, most: int, steps: int = 48) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the ``most`` largest eigenvalues, the largest first, halved ``steps`` times."""
    reach = np.abs(np.concatenate([[0], off])) + np.abs(np.concatenate([off, [0]]))
    low = np.full(most, (diagonal - reach).min())
    high = np.full(most, (diagonal + reach).max())
    pad = 1e-12 * max(np.abs(low).max(), np.abs(high).max()) + 1e-300
    low, high, n = low - pad, high + pad, len(diagonal)
    rank = n - np.arange(most)  # an eigenvalue of that rank from below is at or above a shift with fewer below it
    for _ in range(steps):
        middle = (low + high) / 2
        below = counts_below(diagonal, off, middle) >= rank
        low, high = np.where(below, low, middle), np.where(below, middle, high)
    return low, high


def intervals(matrix: np.ndarray, components: int) -> list[tuple[float, float, int]]:
    """``(from, to, eigenvalues)`` that hold the largest eigenvalues, cut in the widest gaps."""
    diagonal, off = tridiagonal(matrix)
    n = len(diagonal)
    low, high = brackets(diagonal, off, min(n, components + 1))
    top = high[0]
    if top <= 0:
        return []
    good = int((low > FLOOR * top).sum())
    want = min(components, good)
    if not want:
        return []
    # Where the last wanted eigenvalue has equals behind it, all of them are taken into the last interval.
    known = np.concatenate([(low + high) / 2, [0.0 if len(low) == n else low[-1]]])
    last = want
    while last < len(low) and known[last - 1] - known[last] <= 1e-9 * top:
        last += 1
    if last == len(low) and last < n:
        low, high = brackets(diagonal, off, n)
        known = np.concatenate([(low + high) / 2, [0.0]])
        while last < n and known[last - 1] - known[last] <= 1e-9 * top:
            last += 1
    cuts = [top + max(known[0] - known[min(1, last)], 1e-3 * top)]
    at, gaps = 0, known[:last] - known[1:last + 1]
    while at < last:
        ahead = gaps[at:min(at + TOGETHER, last)]
        step = last - at if len(ahead) == last - at else int(ahead.argmax()) + 1
        at += step
        cuts.append(float((known[at - 1] + known[at]) / 2) if at < n else float(known[at - 1] - max(0.5 * known[at - 1], 1e-3 * top)))
    found = counts_below(diagonal, off, np.array(cuts))
    return [(float(cuts[k + 1]), float(cuts[k]), int(found[k] - found[k + 1])) for k in range(len(cuts) - 1) if found[k] > found[k + 1]]


# ---------------------------------------------------------------- contour integration

def projected(matrix: np.ndarray, block: np.ndarray, low: float, high: float) -> np.ndarray:
    """The block's part along the eigenvectors of the interval, by quadrature over the upper half circle."""
    middle, radius = (low + high) / 2, (high - low) / 2
    nodes, weights = np.polynomial.legendre.leggauss(POINTS)
    out = np.zeros_like(block)
    for node, weight in zip(nodes, weights, strict=True):
        turn = radius * np.exp(0.5j * np.pi * (node + 1))
        solved = np.linalg.solve((middle + turn) * np.eye(len(matrix)) - matrix, block.astype(complex))
        out += 0.5 * weight * (turn * solved).real
    return out


def ritz(matrix: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values and vectors of the matrix on the space of the block, rising."""
    basis = np.linalg.qr(np.linalg.qr(block)[0])[0]
    values, turn = np.linalg.eigh(basis.T @ matrix @ basis)
    return values, basis @ turn


def inside(matrix: np.ndarray, low: float, high: float, count: int) -> np.ndarray:
    """The eigenvectors, in columns, of the ``count`` eigenvalues of an interval."""
    n, scale = len(matrix), np.abs(matrix).sum(axis=1).max()
    width = min(n, count + max(3, count // 2))
    while True:
        block = np.random.default_rng(11).standard_normal((n, width))
        best = np.inf
        for turn in range(ROUNDS):
            values, vectors = ritz(matrix, projected(matrix, block, low, high) if width < n else block)
            take = (values > low) & (values <= high)
            if width == n:
                # The whole space: the values nearest to the interval are those inside.
                order = np.argsort(np.abs(values - (low + high) / 2))[:count]
                return vectors[:, np.sort(order)]
            if take.sum() == count:
                found = vectors[:, take]
                error = np.linalg.norm(matrix @ found - found * values[take], axis=0).max()
                if error <= RESIDUAL * n * scale or (turn > 2 and error > 0.5 * best and error <= 100 * RESIDUAL * n * scale):
                    return found
                best = min(best, error)
            block = vectors
        width = min(n, 2 * width)


def components(spark: SparkSession, matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit vectors in columns. Each interval is a task."""
    cut = intervals(matrix, most)
    if not cut:
        return np.zeros(0), np.zeros((len(matrix), 0))

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for low, high, count in zip(*(batch.column(c).to_pylist() for c in ("low", "high", "count")), strict=True):
                rows += inside(matrix, low, high, count).T.tolist()
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64()))], ["vector"])

    table = spark.createDataFrame(cut, "low double, high double, count int").repartition(len(cut))
    got = table.mapInArrow(solve, "vector array<double>").collect()  # one row per component and those equal to the last
    found = np.array([r["vector"] for r in got], np.float64)
    found = found[np.lexsort(found.T)]  # rows arrive in any order
    values, vectors = ritz(matrix, found.T)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    largest = vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))]
    return values, vectors * np.where(largest < 0, -1.0, 1.0)


# ---------------------------------------------------------------- rows

def _whole(column: pa.ListArray, scale: int, offset: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows remain, and their entries as whole numbers, a row each."""
    sizes = np.diff(column.offsets.to_numpy())
    live = (sizes > 0) & ~column.is_null().to_numpy(zero_copy_only=False)
    first = column.offsets.to_numpy()[:-1]
    if not live.any():
        return np.zeros(0, np.int64), np.zeros((0, 0), np.int64)
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    odd = np.concatenate([[0], (~np.isfinite(values)).cumsum()])
    live &= odd[first + sizes] == odd[first]
    rows = np.flatnonzero(live)
    if not len(rows):
        return rows, np.zeros((0, 0), np.int64)
    size = sizes[rows[0]]
    if (sizes[rows] != size).any():
        raise ValueError("vectors have several lengths")
    scaled = np.floor(scale * values[first[rows][:, None] + np.arange(size)])
    if np.abs(scaled).max() >= 2.0 ** 62:
        raise OverflowError("a component is beyond 64 bits")
    return rows, scaled.astype(np.int64) + offset


def _products(y: np.ndarray) -> np.ndarray:
    """Sums of products of columns, as exact integers."""
    most = int(np.abs(y).max(initial=0))
    if most * most * len(y) < 1 << 53:
        wide = y.astype(np.float64)
        return (wide.T @ wide).astype(np.int64).astype(object)
    return y.astype(object).T @ y.astype(object)


def _decimals(values: list[int]) -> pa.Array:
    return pa.array([Decimal(v) for v in values], pa.decimal128(38, 0))


@dataclass
class Whitening:
    """Mean and components of the fit list, and how to apply them to rows."""

    rows: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    scale: int = SCALE
    offset: int = OFFSET
    identity_error: float = 0.0

    def __post_init__(self):
        self.whole = np.array([s // self.rows for s in self.sums], np.int64)
        self.rest = np.array([s % self.rows for s in self.sums], np.int64)

    def whitened(self, y: np.ndarray) -> np.ndarray:
        """Rows less the whole part of the mean, projected and scaled."""
        return (y - self.rest / self.rows) @ self.vectors / np.sqrt(self.values)

    def deviations(self, y: np.ndarray) -> np.ndarray:
        """Sums over dimensions of ``(n * x - S) ** 2``."""
        apart = self.rows * y.astype(np.float64) - self.rest
        if (apart * apart).sum(axis=1).max(initial=0) >= 2.0 ** 63 * 0.999:
            raise OverflowError("a deviation is beyond 64 bits")
        exact = self.rows * y - self.rest
        return (exact * exact).sum(axis=1)


def _sums(vectors: DataFrame, scale: int, offset: int) -> tuple[int, list[int]]:
    """Rows and sums by dimension: a row per dimension from each task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, sums = 0, None
        for batch in batches:
            rows, x = _whole(batch.column(0), scale, offset)
            if len(rows):
                part = x.astype(object).sum(axis=0) if np.abs(x).max() >= 1 << 40 else x.sum(axis=0).astype(object)
                if sums is not None and len(sums) != len(part):
                    raise ValueError("vectors have several lengths")
                count, sums = count + len(rows), part if sums is None else sums + part
        if count:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(sums)), pa.int32()), pa.array([count] * len(sums), pa.int64()), _decimals(sums)], ["i", "n", "s"])

    made = vectors.mapInArrow(run, "i int, n bigint, s decimal(38,0)")
    got = made.groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").cast("decimal(38,0)").alias("s")).orderBy("i").collect()
    if len({r["n"] for r in got}) > 1:
        raise ValueError("vectors have several lengths")
    return (got[0]["n"] if got else 0), [int(r["s"]) for r in got]


def _covariance(vectors: DataFrame, rows: int, sums: list[int], scale: int, offset: int) -> np.ndarray:
    """Exact numerators over ``rows ** 2``, each rounded once."""
    size, whole = len(sums), np.array([s // rows for s in sums], np.int64)
    at = np.triu_indices(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            kept, x = _whole(batch.column(0), scale, offset)
            if len(kept):
                part = _products(x - whole)
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(at[0], pa.int32()), pa.array(at[1], pa.int32()), _decimals(total[at].tolist())], ["i", "j", "g"])

    made = vectors.mapInArrow(run, "i int, j int, g decimal(38,0)")
    got = made.groupBy("i", "j").agg(F.sum("g").cast("decimal(38,0)").alias("g")).collect()
    out, rest = np.zeros((size, size)), [s % rows for s in sums]
    for r in got:
        i, j = r["i"], r["j"]
        out[i, j] = out[j, i] = (rows * int(r["g"]) - rest[i] * rest[j]) / rows ** 2
    return out


def _identity_error(vectors: DataFrame, model: Whitening) -> float:
    """Largest entry, in size, of the covariance of the whitened rows less the identity."""
    size = len(model.values)
    at = np.triu_indices(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products, sums = np.zeros((size, size)), np.zeros(size)
        for batch in batches:
            kept, x = _whole(batch.column(0), model.scale, model.offset)
            if len(kept):
                z = model.whitened(x - model.whole)
                products, sums = products + z.T @ z, sums + z.sum(axis=0)
        rows = [*zip(at[0].tolist(), at[1].tolist(), products[at].tolist()), *((-1, k, s) for k, s in enumerate(sums.tolist()))]
        i, j, v = (list(c) for c in zip(*rows))
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(v, pa.float64())], ["i", "j", "v"])

    got = vectors.mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    mean = np.zeros(size)
    for r in got:
        if r["i"] < 0:
            mean[r["j"]] = r["v"] / model.rows
    return max(abs(r["v"] / model.rows - mean[r["i"]] * mean[r["j"]] - (r["i"] == r["j"])) for r in got if r["i"] >= 0)


def fit(df: DataFrame, vector: str = "embedding", most: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET) -> Whitening | None:
    """Learn from all remaining rows; None without any. What reaches the driver is as large as the
    dimensions squared."""
    vectors = df.select(F.col(vector).cast("array<double>").alias("v"))
    rows, sums = _sums(vectors, scale, offset)
    if not rows:
        return None
    matrix = _covariance(vectors, rows, sums, scale, offset)
    values, axes = components(df.sparkSession, matrix, most)
    model = Whitening(rows, sums, values, axes, float(matrix.trace()), scale, offset)
    if len(values):
        model.identity_error = _identity_error(vectors, model)
    return model


def whiten(df: DataFrame, model: Whitening | None, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """A row for each remaining vector and component: the key, ``component``, ``n``, ``deviation``,
    ``whitened``, ``explained`` and ``identity_error``."""
    kind = df.schema[key].dataType
    schema = T.StructType([T.StructField(key, kind), *T.StructType.fromDDL(
        "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double").fields])
    if model is None or not len(model.values):
        return df.sparkSession.createDataFrame([], schema)
    size = len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, x = _whole(batch.column(1), model.scale, model.offset)
            if not len(kept):
                continue
            y, many = x - model.whole, len(kept) * size
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(np.repeat(kept, size))), pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), len(kept))),
                pa.array(np.full(many, model.rows)), pa.array(np.repeat(model.deviations(y), size)), pa.array(model.whitened(y).ravel()),
                pa.array(np.tile(model.values / model.trace, len(kept))), pa.array(np.full(many, model.identity_error))], schema.names)

    return df.select(key, F.col(vector).cast("array<double>").alias("_vector")).mapInArrow(run, schema)
