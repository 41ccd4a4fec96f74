"""Whitening of embeddings: principal components of the fit vectors, each scaled to unit variance.

Entries become whole numbers first, so that counts and sums are exact. One pass over the vectors gives their number
and the sum of each dimension; a second one the covariance, centred before multiplying: every task adds up one
dimensions x dimensions matrix over its rows, and the tasks' matrices are added row by row in a shuffle. The driver
holds that one matrix, whose size depends on the dimensions alone. There Householder reflections make it tridiagonal,
bisection on Sturm counts finds the leading eigenvalues, and inverse iteration their vectors, which are
reorthogonalised within clusters of close eigenvalues. The components, dimensions x (a few), are broadcast, and a
third pass projects every vector on them.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bowline.llm.common import unused
from bowline.llm.densevectors import finite, matrix, scaled

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCALE, SHIFT = 1024, 100_000
CHUNK = 4096  # rows of one product
CLUSTER = 1e-3  # eigenvalues so close, by the norm of the matrix, form a cluster
RANK = 1e-12  # eigenvalues below this, by dimension and the largest one, count as zero


def tridiagonal(symmetric: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, off-diagonal, q) of a symmetric matrix: q.T @ symmetric @ q, by Householder reflections."""
    a = np.array(symmetric, float)
    n = len(a)
    q, off = np.eye(n), np.zeros(max(0, n - 1))
    for k in range(n - 1):
        x = a[k + 1 :, k].copy()
        norm = float(np.sqrt(x @ x))
        off[k] = x[0]
        if len(x) > 1 and np.any(x[1:]):
            off[k] = -norm if x[0] >= 0 else norm
            x[0] -= off[k]
            x /= np.sqrt(x @ x)
            rest = a[k + 1 :, k + 1 :]
            p = rest @ x
            p -= (x @ p) * x
            rest -= 2.0 * (np.outer(x, p) + np.outer(p, x))
            q[:, k + 1 :] -= 2.0 * np.outer(q[:, k + 1 :] @ x, x)
    return np.diag(a).copy(), off, q


def count_below(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sturm counts: how many eigenvalues are below each of the numbers ``at``."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    pivot = diagonal[0] - at
    below = (pivot < 0).astype(int)
    for d, e in zip(diagonal[1:], off, strict=True):
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        pivot = d - at - e * (e / pivot)
        below += pivot < 0
    return below


def leading_eigenvalues(diagonal: np.ndarray, off: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` largest eigenvalues, falling, by bisection to neighbouring doubles."""
    n = len(diagonal)
    reach = np.concatenate([[0.0], np.abs(off)]) + np.concatenate([np.abs(off), [0.0]])
    low = np.full(count, (diagonal - reach).min())
    high = np.full(count, (diagonal + reach).max())
    pad = np.finfo(float).eps * max(1e-300, np.abs(low[0]), np.abs(high[0]))
    low, high = low - 2 * n * pad, high + 2 * n * pad
    ahead = n - 1 - np.arange(count)  # eigenvalues below the wanted one
    while True:
        middle = low + (high - low) / 2
        if np.all((middle <= low) | (middle >= high)):
            return middle
        above = count_below(diagonal, off, middle) > ahead  # the wanted one is below the middle
        low, high = np.where(above, low, middle), np.where(above, middle, high)


def solve_shifted(diagonal: np.ndarray, off: np.ndarray, shift: float, right: np.ndarray, tiny: float) -> np.ndarray:
    """The solution of (T - shift) x = right, by elimination with row exchanges; zero pivots become ``tiny``."""
    n = len(diagonal)
    d, up, up2 = (diagonal - shift).tolist(), [*off.tolist(), 0.0], [0.0] * n
    x = right.tolist()
    for i in range(n - 1):
        below, nxt, far = float(off[i]), d[i + 1], up[i + 1]
        if abs(below) > abs(d[i]):  # exchange rows i and i + 1
            factor = d[i] / below
            d[i], d[i + 1] = below, up[i] - factor * nxt
            up[i], up[i + 1], up2[i] = nxt, -factor * far, far
            x[i], x[i + 1] = x[i + 1], x[i] - factor * x[i + 1]
        else:
            pivot = d[i] if abs(d[i]) > tiny else tiny
            d[i] = pivot
            factor = below / pivot
            d[i + 1] = nxt - factor * up[i]
            x[i + 1] -= factor * x[i]
    for i in range(n - 1, -1, -1):
        value = x[i]
        if i + 1 < n:
            value -= up[i] * x[i + 1]
        if i + 2 < n:
            value -= up2[i] * x[i + 2]
        x[i] = value / (d[i] if abs(d[i]) > tiny else tiny)
        if abs(x[i]) > 1e200:  # only the direction counts
            x = [v * 1e-200 for v in x]
    return np.array(x)


def inverse_iteration(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors, as columns, of falling eigenvalues; those of a cluster are made orthogonal to each other."""
    n, eps = len(diagonal), np.finfo(float).eps
    norm = float(np.max(np.abs(diagonal)) + 2 * np.max(np.abs(off), initial=0.0)) or 1.0
    rng = np.random.default_rng(12)
    out = np.zeros((n, len(values)))
    first, shift = 0, np.inf
    for k, value in enumerate(values):
        if k and values[k - 1] - value > CLUSTER * norm:
            first = k
        shift = min(value, shift - 2 * eps * norm) if k > first else value  # equal eigenvalues: distinct shifts
        x = rng.standard_normal(n)
        for _ in range(5):
            for _ in range(2):
                x -= out[:, first:k] @ (out[:, first:k].T @ x)
            x /= np.max(np.abs(x))
            x /= np.sqrt(x @ x)
            x = solve_shifted(diagonal, off, shift, x, eps * norm)
            x /= np.max(np.abs(x))
        for _ in range(2):
            x -= out[:, first:k] @ (out[:, first:k].T @ x)
            x /= np.sqrt(x @ x)
        out[:, k] = x
    return out


def leading_components(covariance: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Falling positive eigenvalues, at most ``count``, and their unit eigenvectors as columns."""
    scale = float(np.max(np.abs(covariance), initial=0.0))
    if not scale:
        return np.zeros(0), np.zeros((len(covariance), 0))
    diagonal, off, q = tridiagonal(covariance / scale)
    values = leading_eigenvalues(diagonal, off, min(count, len(diagonal)))
    values = values[values > RANK * len(diagonal) * values[0]]
    vectors = q @ inverse_iteration(diagonal, off, values)
    return values * scale, vectors / np.sqrt((vectors * vectors).sum(0))


@dataclass(frozen=True)
class Whitening:
    """Number and exact sums of the fit vectors, trace and leading components of their covariance."""

    n: int
    sums: tuple[int, ...]
    trace: float
    values: np.ndarray
    vectors: np.ndarray

    @property
    def explained(self) -> list[float]:
        return [float(v) / self.trace for v in self.values]

    @property
    def centre(self) -> tuple[np.ndarray, np.ndarray]:
        """The mean as whole numbers and the fractions left over."""
        whole = [(2 * s + self.n) // (2 * self.n) for s in self.sums]
        return np.array(whole, np.int64), np.array([(s - w * self.n) / self.n for s, w in zip(self.sums, whole, strict=True)])


def exact_squares(rows: np.ndarray, n: int, rest: list[int]) -> list[Decimal]:
    """The sum over dimensions of (n * row + rest) ** 2, for every row, exactly."""
    reach = (n * int(np.abs(rows).max(initial=0)) + max(map(abs, rest), default=0)) ** 2 * rows.shape[1]
    kind = np.int64 if reach < 2**63 else object  # beyond 64 bits numpy computes with Python's integers
    moved = rows.astype(kind) * n + np.array(rest, kind)
    return [Decimal(int(v)) for v in (moved * moved).sum(1)]


def usable(vectors: DataFrame, vector: str) -> DataFrame:
    return vectors.filter(finite(vector))


def whole_numbers(column: pa.Array) -> np.ndarray:
    return scaled(matrix(column), SCALE) + SHIFT


def fit(vectors: DataFrame, vector: str = "embedding", components: int = 8) -> Whitening:
    """Components of the vectors' whole numbers floor(1024 * entry) + 100000, numbered by falling variance.

    Vectors that are null, have no entries, or hold a null or non-finite entry take no part; the others must have one
    length, and entries below 2 ** 43. Repeated rows count as often as they come. Directions without variance are no
    components, so there may be fewer than ``components``: none for an empty table or equal vectors.
    """
    rows = usable(vectors, vector).select(F.col(vector).cast("array<double>").alias("v"))

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high = low = n = 0
        for batch in batches:
            if batch.num_rows:
                x = whole_numbers(batch.column(0))
                high, low, n = high + (x >> 32).sum(0), low + (x & 0xFFFFFFFF).sum(0), n + len(x)
        if n:
            columns = [np.arange(len(high)), high, low, np.full(len(high), n)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["dim", "high", "low", "n"])

    total = F.sum(F.col("high").cast("decimal(38,0)") * 4294967296 + F.col("low")).cast("decimal(38,0)")
    parts = rows.mapInArrow(add_up, "dim long, high long, low long, n long")
    sums = parts.groupBy("dim").agg(total.alias("total"), F.sum("n").alias("n")).orderBy("dim").collect()
    if not sums:
        return Whitening(0, (), 0.0, np.zeros(0), np.zeros((0, 0)))
    if len({row["n"] for row in sums}) > 1:
        raise ValueError("vectors of several lengths in one table")
    model = Whitening(sums[0]["n"], tuple(int(row["total"]) for row in sums), 0.0, np.zeros(0), np.zeros((len(sums), 0)))
    centre, fraction = model.centre

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, products = 0, np.zeros((len(centre), len(centre)))
        for batch in batches:
            x = whole_numbers(batch.column(0)) - centre if batch.num_rows else np.zeros((0, len(centre)))
            for lo in range(0, len(x), CHUNK):
                y = x[lo : lo + CHUNK] - fraction
                products += y.T @ y
                seen += len(y)
        if seen:
            yield from matrix_rows(products)

    summed = rows.mapInArrow(moments, "dim int, cells binary").repartition("dim").mapInArrow(add_rows, "dim int, cells binary")
    cells = {row["dim"]: np.frombuffer(row["cells"]) for row in summed.collect()}  # one row per dimension
    covariance = np.stack([cells[i] for i in range(len(centre))]) / model.n
    covariance = (covariance + covariance.T) / 2
    return Whitening(model.n, model.sums, float(np.trace(covariance)), *leading_components(covariance, components))


def matrix_rows(cells: np.ndarray) -> Iterator[pa.RecordBatch]:
    for i, row in enumerate(cells):
        yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([row.tobytes()], pa.binary())], names=["dim", "cells"])


def add_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of the matrix rows that meet in a task."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            sums[i] = sums.get(i, 0.0) + np.frombuffer(cells)
    for i, row in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([row.tobytes()], pa.binary())], names=["dim", "cells"])


def transform(vectors: DataFrame, model: Whitening, vector: str = "embedding") -> DataFrame:
    """The usable rows of ``vectors`` with ``deviation`` and ``whitened`` in place of the vector.

    ``deviation``, decimal(38,0): the sum over dimensions of (n * x - S) ** 2, exactly. ``whitened``, an array of
    double: (x - S / n) on each component, over the root of its eigenvalue. A new column whose name is taken gets
    underscores; other columns are carried along, nulls too. An empty table gives no rows.
    """
    others = [c for c in vectors.columns if c != vector]
    inside = [f"c{i}" for i in range(len(others))]
    if model.n:
        centre, fraction = model.centre
        rest = [model.n * int(c) - s for c, s in zip(centre, model.sums, strict=True)]
        shared = vectors.sparkSession.sparkContext.broadcast((centre, fraction, model.vectors / np.sqrt(model.values)))
    n = model.n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows or not n:
                continue
            centre, fraction, projection = shared.value
            y = whole_numbers(batch.column(len(inside))) - centre
            out = (y - fraction) @ projection
            deviation = pa.array(exact_squares(y, n, rest), pa.decimal128(38, 0))
            firsts = np.arange(0, out.size + 1, out.shape[1]) if out.shape[1] else np.zeros(len(out) + 1)
            lists = pa.ListArray.from_arrays(pa.array(firsts, pa.int32()), pa.array(out.reshape(-1), pa.float64()))
            columns = [batch.column(i) for i in range(len(inside))]
            yield pa.RecordBatch.from_arrays([*columns, deviation, lists], names=[*inside, "deviation", "whitened"])

    kinds = {f.name: f.dataType.simpleString() for f in vectors.schema}
    schema = ", ".join([*(f"{i} {kinds[c]}" for i, c in zip(inside, others, strict=True)), "deviation decimal(38,0)", "whitened array<double>"])
    columns = [F.col(f"`{c}`").alias(i) for c, i in zip(others, inside, strict=True)]
    rows = usable(vectors, vector).select(*columns, F.col(vector).cast("array<double>").alias("v"))
    names = unused(vectors.select(*[f"`{c}`" for c in others]), "deviation", "whitened")
    return rows.mapInArrow(run, schema).toDF(*others, *names)


def identity_error(whitened: DataFrame, components: int, column: str = "whitened") -> float:
    """The largest absolute entry of the covariance of ``column`` less the identity; 0 without rows or components."""
    if not components:
        return 0.0
    pairs = [(i, j) for i in range(components) for j in range(i + 1)]
    at = lambda i: F.col(column)[i]
    found = whitened.agg(*[F.covar_pop(at(i), at(j)).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max((abs(v - (i == j)) for v, (i, j) in zip(found, pairs, strict=True) if v is not None), default=0.0)
