"""Operator 11: whitening of embeddings by the leading components of their covariance.

1. Fit list. Entries become whole steps ``floor(scale * entry)``; each distinct vector counts
   once, copies are combined before the shuffle. The list is written to the shared folder.
2. Sums per dimension, exact, and the covariance of the vectors less their mean: every task adds
   up its own blocks, the tasks' sums are added by row of the matrix (``vectors.added_up``).
3. Components, on the driver, whose matrix has the vectors' dimensions and not their number:
   Householder reflections make it tridiagonal, bisection on Sturm counts finds the leading
   eigenvalues, inverse iteration their vectors, made orthogonal within clusters of close
   eigenvalues; the reflections carry them back.
4. The projection is broadcast (dimensions x components numbers) and every row is projected
   where it lies, map-only. One more pass over the fit list measures the whitened covariance.

Rows with a null or empty vector, a null or non-finite entry, or an entry of 2^40 steps or more are left out;
of vectors of several lengths the length with the most distinct vectors counts (ties: the longer),
others are left out. Null and repeated ids stay as they are, and equal vectors give equal rows. A
component without variance (below rounding of the whole variance) cannot be whitened and is not returned, so
there are fewer components where the vectors span fewer dimensions, and none for a single
distinct vector. Empty tables give empty results. Only the id and the vector are read: further
columns, whatever their names, do not come out; join them by id. ``rows`` is read twice: pass a table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.llm.tables import Scratch, column
from marketlake.llm.vectors import added_up, blocks, by_length, packed, unpacked

#: Steps from which on an entry is taken for broken: sums stay exact below it.
_LIMIT = 1 << 40
_SPLIT = 20


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and the unit reflection vectors that bring a symmetric matrix there."""
    a, n, reflections = np.array(a, np.float64), len(a), []
    for k in range(n - 2):
        x = a[k + 1:, k].copy()
        size = np.linalg.norm(x)
        if not np.linalg.norm(x[1:]):
            reflections.append(np.zeros_like(x))  # there already
            continue
        x[0] += np.copysign(size, x[0])
        v = x / np.linalg.norm(x)
        rest = a[k + 1:, k + 1:]
        p = rest @ v
        w = p - (v @ p) * v
        rest -= 2 * (np.outer(v, w) + np.outer(w, v))
        head = a[k + 1:, k]
        head -= 2 * (v @ head) * v
        a[k, k + 1:] = head
        reflections.append(v)
    return a.diagonal().copy(), a.diagonal(1).copy(), reflections


def below(d: np.ndarray, e: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """Sturm counts: how many eigenvalues of a tridiagonal matrix lie below each shift."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    q = d[0] - shifts
    count = (q < 0).astype(int)
    for k in range(1, len(d)):
        q = d[k] - shifts - e[k - 1] ** 2 / np.where(np.abs(q) < tiny, np.where(q < 0, -tiny, tiny), q)
        count += q < 0
    return count


def leading_eigenvalues(d: np.ndarray, e: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, each halved in to the last bit."""
    reach = np.r_[0, np.abs(e)] + np.r_[np.abs(e), 0]
    low, high = np.full(k, (d - reach).min()), np.full(k, (d + reach).max())
    low, high = low - 1e-9 * np.abs(low) - 1e-300, high + 1e-9 * np.abs(high) + 1e-300
    wanted = len(d) - np.arange(k)  # the j-th largest has n - j below anything beyond it
    for _ in range(200):
        middle = low + (high - low) / 2
        if ((middle <= low) | (middle >= high)).all():
            break
        beyond = below(d, e, middle) >= wanted
        low, high = np.where(beyond, low, middle), np.where(beyond, middle, high)
    return low + (high - low) / 2


def _solver(d: np.ndarray, e: np.ndarray, shift: float, least: float):
    """Solves ``(T - shift) x = b`` by elimination with row exchanges; pivots below ``least`` are raised to it."""
    n = len(d)
    rows, steps = [[d[0] - shift, e[0] if n > 1 else 0.0, 0.0]], []
    for k in range(n - 1):
        here, under = rows[k], [e[k], d[k + 1] - shift, e[k + 1] if k + 2 < n else 0.0]
        swap = abs(under[0]) > abs(here[0])
        if swap:
            here, under = under, here
        if abs(here[0]) < least:
            here = [least, *here[1:]]
        factor = under[0] / here[0]
        rows[k] = here
        rows.append([under[1] - factor * here[1], under[2] - factor * here[2], 0.0])
        steps.append((swap, factor))
    if abs(rows[-1][0]) < least:
        rows[-1][0] = least

    def solve(b: np.ndarray) -> np.ndarray:
        x = list(b) + [0.0, 0.0]
        for k, (swap, factor) in enumerate(steps):
            if swap:
                x[k], x[k + 1] = x[k + 1], x[k]
            x[k + 1] -= factor * x[k]
        for k in range(n - 1, -1, -1):
            x[k] = (x[k] - rows[k][1] * x[k + 1] - rows[k][2] * x[k + 2]) / rows[k][0]
        return np.array(x[:n])

    return solve


def eigenvectors(d: np.ndarray, e: np.ndarray, values: np.ndarray, rounds: int = 6) -> np.ndarray:
    """Unit vectors, a column each, by inverse iteration. Values closer than a thousandth of the
    matrix's size to the one before belong to its cluster, whose vectors are kept orthogonal."""
    size = max(np.abs(d).max(), np.abs(e).max() if len(e) else 0.0)
    least = size * np.finfo(float).eps
    out, cluster = np.zeros((len(d), len(values))), 0
    rng = np.random.default_rng(11)
    for j, value in enumerate(values):
        if j and values[j - 1] - value > 1e-3 * size:
            cluster = j
        shift = value
        if j > cluster:  # equal shifts would give equal vectors
            shift = min(value, last - 10 * least)
        last = shift
        solve, x = _solver(d, e, shift, least), rng.normal(size=len(d))
        for _ in range(rounds):
            for _ in range(2):  # twice is enough to be orthogonal to rounding
                x = x - out[:, cluster:j] @ (out[:, cluster:j].T @ x)
            x = solve(x / np.linalg.norm(x))
            x = x / np.linalg.norm(x)
        for _ in range(2):
            x = x - out[:, cluster:j] @ (out[:, cluster:j].T @ x)
            x = x / np.linalg.norm(x)
        out[:, j] = x
    return out


def leading_components(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` leading eigenvalues of a symmetric matrix, falling, and their unit vectors as columns."""
    k = min(k, len(a))
    size = np.abs(a).max() if len(a) else 0.0
    if not k or not size:
        return np.zeros(k), np.eye(len(a))[:, :k]
    d, e, reflections = tridiagonal(a / size)
    vectors = eigenvectors(d, e, leading_eigenvalues(d, e, k))
    for j in range(len(reflections) - 1, -1, -1):
        v = reflections[j]
        vectors[j + 1:] -= 2 * np.outer(v, v @ vectors[j + 1:])
    vectors /= np.linalg.norm(vectors, axis=0)
    values = np.einsum("ij,ij->j", vectors, (a / size) @ vectors) * size
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


def fit_list(vectors: DataFrame, scale: int) -> DataFrame:
    """(dims, x): every distinct valid vector once, in whole steps. ``vectors`` has one column."""
    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            for _, x in by_length(batch.column(0), scale, _LIMIT):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), x.shape[1]), pa.int32()), packed(x)], names=["dims", "x"])

    return vectors.mapInArrow(steps, "dims int, x binary").distinct()


@dataclass(frozen=True)
class Whitening:
    """What the fit list of ``n`` vectors gives: exact ``sums`` per dimension, the whole variance
    ``trace``, eigenvalues ``variances`` and their vectors as columns of ``components``."""

    dims: int
    n: int
    sums: list[int]
    trace: float
    variances: np.ndarray
    components: np.ndarray

    @property
    def mean(self) -> np.ndarray:
        return np.array([s // self.n + (s % self.n) / self.n for s in self.sums])

    def project(self, x: np.ndarray) -> np.ndarray:
        """Rows of whole steps, whitened."""
        return (x - self.mean) @ self.components / np.sqrt(self.variances)

    def deviations(self, x: np.ndarray) -> pa.Array:
        """``sum((n * x - sums) ** 2)`` of each row, exact, as decimal(38, 0)."""
        most = self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums))
        kind = np.int64 if self.dims * most ** 2 < 1 << 63 else object  # else in whole numbers of any size
        found = np.square(self.n * x.astype(kind) - np.array(self.sums, kind)).sum(1)
        if kind is object:
            from decimal import Decimal
            return pa.array([Decimal(v) if abs(v) < 10 ** 38 else None for v in found], pa.decimal128(38, 0))
        return pa.array(found, pa.int64()).cast(pa.decimal128(38, 0))


def _partial(rows: DataFrame, dims: int, add) -> DataFrame:
    """(key, value): the rows of the matrix that ``add(x)`` returns, added up over each task's blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in blocks(batches):
            part = add(unpacked(batch.column(0), np.int64, dims))
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), packed(total)], names=["key", "value"])

    return rows.select("x").mapInArrow(run, "key int, value binary")


def _added(rows: DataFrame, dims: int, add, dtype: type) -> np.ndarray:
    found = added_up(_partial(rows, dims, add), dtype)
    return np.array([value for _, value in found])


def fit(vectors: DataFrame, scratch: Scratch, components: int, scale: int) -> tuple[Whitening | None, DataFrame]:
    """The whitening of a table of vectors (one column), and its fit list; None without a valid vector."""
    listed = scratch.write(fit_list(vectors, scale), "distinct")
    longest = listed.groupBy("dims").count().orderBy(F.desc("count"), F.desc("dims")).first()
    if longest is None:
        return None, listed
    dims, n = longest["dims"], longest["count"]
    rows = listed.where(F.col("dims") == dims).select("x")
    # high and low bits apart, so that no sum leaves 64 bits
    high, low = _added(rows, dims, lambda x: np.array([(x >> _SPLIT).sum(0), (x & ((1 << _SPLIT) - 1)).sum(0)]), np.int64)
    sums = [(int(h) << _SPLIT) + int(l) for h, l in zip(high, low, strict=True)]
    plain = Whitening(dims, n, sums, 0.0, np.empty(0), np.empty((dims, 0)))
    mean = plain.mean

    def products(x: np.ndarray) -> np.ndarray:
        y = x - mean
        return y.T @ y

    covariance = _added(rows, dims, products, np.float64) / n
    covariance = (covariance + covariance.T) / 2
    values, found = leading_components(covariance, components)
    trace = float(np.trace(covariance))
    # below this, a value is the rounding of the others
    real = values > max(trace, np.abs(mean).max() ** 2 * np.finfo(float).eps) * dims * np.finfo(float).eps
    return Whitening(dims, n, sums, trace, values[real], found[:, real]), rows


def identity_error(model: Whitening, rows: DataFrame) -> float:
    """The largest absolute entry of the whitened fit list's covariance less the identity."""
    k = len(model.variances)
    if not k:
        return 0.0
    ones = _added(rows, model.dims, lambda x: model.project(x).sum(0)[None, :], np.float64)[0]
    middle = ones / model.n

    def products(x: np.ndarray) -> np.ndarray:
        y = model.project(x) - middle
        return y.T @ y

    return float(np.abs(_added(rows, model.dims, products, np.float64) / model.n - np.eye(k)).max())


def whiten(rows: DataFrame, scratch: Scratch, components: int = 4, scale: int = 256, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """One row per row of a valid vector and component (numbered from 1): ``id_col``, ``component``, ``n``
    (vectors of the fit list), ``deviation`` (decimal, exact), ``whitened``, ``explained`` (share of the
    whole variance) and ``identity_error``."""
    vectors = rows.select(column(vector_col).cast("array<double>").alias("v"))
    ids = rows.select(column(id_col).alias(id_col), column(vector_col).cast("array<double>").alias("v"))
    schema = T.StructType([ids.schema[0], T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
                           T.StructField("deviation", T.DecimalType(38, 0)), T.StructField("whitened", T.DoubleType()),
                           T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType())])
    with scratch.part("fit") as work:
        model, listed = fit(vectors, work, components, scale)
        error = identity_error(model, listed) if model else 0.0
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        k = len(m.variances)
        for batch in blocks(batches):
            for places, x in by_length(batch.column(1), scale, _LIMIT):
                if x.shape[1] != m.dims or not k or not len(x):
                    continue
                each = np.repeat(np.arange(len(x)), k)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(places[each])), pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                    pa.array(np.full(len(each), m.n), pa.int64()), m.deviations(x).take(pa.array(each)), pa.array(m.project(x).ravel()),
                    pa.array(np.tile(m.variances / m.trace, len(x))), pa.array(np.full(len(each), error))], names=schema.names)

    return ids.mapInArrow(project, schema)
