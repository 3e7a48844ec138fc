"""Operator 12: centroid clustering with geometric drift tightening.

Vectors are whole steps, centroids too (floored means), so distances, ties and results are exact.
A row of the working table holds a vector, its cluster, a number that its distance to its own centroid
does not exceed (``upper``) and one that its distance to every other centroid is at least
(``lower``). After each move of the centroids:

1. ``upper`` grows by the drift of the row's own centroid. ``lower`` falls by what the others can
   have come nearer at most. All rows of a cluster lie in a sphere about its centroid as it was; for
   each other centroid, the loss is bounded in the plane of the sphere's centre and the
   centroid's two places: the points that come nearer by a given amount lie within a branch of a
   hyperbola, and seen from its middle the sphere stays outside the cone of its asymptotes. With
   the sphere's centre ``l`` away from the middle at an angle ``a`` to the drift, and radius ``r``,
   nothing in the sphere comes nearer by more than ``drift * cos(a - asin(r / l))``; spheres that
   hold the middle lose the whole drift, those behind it nothing.
2. A row whose ``upper`` stays under its ``lower`` keeps its cluster. Else ``upper`` is measured; if
   that does not decide, all centroids are compared exactly.

Every assignment is one pass: tasks read the table of the assignment before, and write the next one,
with the sums, counts, inertia and radius of each cluster as rows of the same table, one per task and
cluster. These are added up by cluster (``vectors.added_up``); the driver holds the centroids
and one row of totals per cluster. No row is shuffled. Each table goes when the next one is written.

Rows with a null vector, one of another length than ``dims``, a null or non-finite entry or one of 2^27
steps or more are left out. Null and repeated ids stay; equal vectors share a cluster. The first centroids are the ``k``
rows with the least hashes of id (``null`` for none), rows of one id by their vectors, so there are fewer
clusters where there are fewer rows; equal centroids are kept, and the later of them stay empty.
Empty tables give empty results. Only the id and the vector are read; join further columns
by id. ``rows`` is read twice: pass a table.
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

#: Steps from which on an entry is taken for broken: squared distances stay exact below it.
_LIMIT = 1 << 27
#: Up to here, products of steps are exact in doubles.
_DOUBLE = 1 << 21
#: Bounds are widened by this share, far above their rounding.
_SLACK = 1e-9


def distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances, a column per centroid."""
    exact = max(np.abs(x).max(initial=0), np.abs(centroids).max(initial=0)) < _DOUBLE
    kind = np.float64 if exact else np.int64
    a, c = x.astype(kind), centroids.astype(kind)
    return (np.square(a).sum(1)[:, None] - 2 * (a @ c.T) + np.square(c).sum(1)).astype(np.int64)


def losses(old: np.ndarray, new: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """For each cluster, how much nearer any other centroid can have come to any point within
    ``radii`` of the cluster's old centroid."""
    k = len(old)
    out = np.zeros(k)
    a, b = old.astype(np.float64), new.astype(np.float64)
    drift = np.sqrt(np.square(b - a).sum(1))
    for i in range(k):
        for j in range(k):
            if j == i or not drift[j]:
                continue
            to = a[i] - (a[j] + b[j]) / 2
            away, reach = np.sqrt(to @ to), radii[i] * (1 + _SLACK)
            if away <= reach:
                out[i] = max(out[i], drift[j])
                continue
            angle = np.arccos(np.clip(to @ (b[j] - a[j]) / (away * drift[j]), -1, 1)) - np.arcsin(reach / away)
            out[i] = max(out[i], min(drift[j], drift[j] * (np.cos(max(0.0, angle)) + _SLACK)))
    return out


class State:
    """What an assignment needs of the one before: the centroids, how far each has moved, and
    the loss of each cluster's lower bounds."""

    def __init__(self, centroids: np.ndarray, before: np.ndarray | None = None, radii: np.ndarray | None = None):
        self.centroids = centroids
        self.drift = np.zeros(len(centroids)) if before is None else np.sqrt(np.square((centroids - before).astype(np.float64)).sum(1))
        self.loss = np.zeros(len(centroids)) if before is None else losses(before, centroids, radii)

    def assign(self, x: np.ndarray, cluster: np.ndarray | None, upper: np.ndarray | None,
               lower: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """(cluster, upper, lower) of the rows after the move, and how many were scanned."""
        if cluster is None:
            cluster, upper, lower = np.zeros(len(x), np.int64), np.full(len(x), np.inf), np.zeros(len(x))
        upper = (upper + self.drift[cluster]) * (1 + _SLACK)
        lower = np.maximum(0.0, (lower - self.loss[cluster]) * (1 - _SLACK) - _SLACK)
        open_ = np.flatnonzero(upper >= lower)
        own = np.square(x[open_] - self.centroids[cluster[open_]]).sum(1)
        upper[open_] = np.sqrt(own) * (1 + _SLACK)
        open_ = open_[upper[open_] >= lower[open_]]
        found = distances(x[open_], self.centroids)
        nearest = found.argmin(1)  # the first of equal ones
        rows = np.arange(len(open_))
        best = found[rows, nearest]
        found[rows, nearest] = np.iinfo(np.int64).max
        cluster, upper, lower = cluster.copy(), upper, lower
        cluster[open_], upper[open_] = nearest, np.sqrt(best) * (1 + _SLACK)
        lower[open_] = np.sqrt(found.min(1)) * (1 - _SLACK) if len(self.centroids) > 1 else np.inf
        return cluster, upper, lower, len(open_)


def first_centroids(rows: DataFrame, k: int, seed: int, scale: int, dims: int) -> np.ndarray:
    """The vectors of the ``k`` rows with the least SHA-256 of ``seed:id``, in that order."""
    good = F.forall("v", lambda c: F.coalesce(F.abs(F.floor(c * scale).cast("double")) < float(_LIMIT), F.lit(False)) & ~F.isnan(c) & (F.abs(c) < float(_LIMIT)))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("null"))), 256)
    named = rows.where((F.size("v") == dims) & good).select(digest.alias("digest"), F.transform("v", lambda c: F.floor(c * scale)).alias("x"))
    return np.array([r.x for r in named.orderBy("digest", "x").limit(k).collect()], np.int64).reshape(-1, dims)


@dataclass(frozen=True)
class Totals:
    """What a pass leaves of each cluster: sums per dimension, rows, inertia (exact), radius; and how
    many rows of the pass were scanned."""

    sums: list[list[int]]
    sizes: list[int]
    inertia: list[int]
    radii: np.ndarray
    scanned: int


_SCHEMA = "x binary, cluster int, upper double, lower double, distance long, key int, value binary"
#: Places of a task's totals after the sums: rows, inertia (high and low bits), rows scanned.
_SIZE, _HIGH, _LOW, _SCANNED = range(4)


def _pass(source: DataFrame, state: State, dims: int, scale: int, last: bool) -> DataFrame:
    """The table of the next assignment. Rows of vectors have id, x, cluster, upper, lower and, in the
    last one, distance in the place of x; rows of a task's totals have key, value and as ``upper`` the radius."""
    k, raw = len(state.centroids), "x" not in source.columns
    shared = source.sparkSession.sparkContext.broadcast(state)
    schema = T.StructType([source.schema["id"], *T.StructType.fromDDL(_SCHEMA).fields])

    def rows_of(batch: pa.RecordBatch) -> Iterator[tuple]:
        if raw:
            yield from ((places, x, None, None, None) for places, x in by_length(batch.column(1), scale, _LIMIT) if x.shape[1] == dims)
        else:
            x = unpacked(batch.column(1), np.int32, dims).astype(np.int64)
            cluster, upper, lower = (np.array(batch.column(c)) for c in (2, 3, 4))
            yield np.arange(len(x)), x, cluster.astype(np.int64), upper, lower

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, kinds = shared.value, None
        totals, radii = np.zeros((k, dims + 4), np.int64), np.zeros(k)

        def out(n: int, **columns: pa.Array) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(n, f.type)) for f in kinds], names=schema.names)

        for batch in blocks(batches):
            kinds = kinds or [pa.field("id", batch.column(0).type), pa.field("x", pa.binary()), pa.field("cluster", pa.int32()),
                              pa.field("upper", pa.float64()), pa.field("lower", pa.float64()), pa.field("distance", pa.int64()),
                              pa.field("key", pa.int32()), pa.field("value", pa.binary())]
            for places, x, cluster, upper, lower in rows_of(batch):
                cluster, upper, lower, scanned = s.assign(x, cluster, upper, lower)
                for c in np.unique(cluster):
                    mine = cluster == c
                    totals[c, :dims] += x[mine].sum(0)
                    totals[c, dims + _SIZE] += mine.sum()
                    radii[c] = max(radii[c], upper[mine].max())
                totals[0, dims + _SCANNED] += scanned
                found = {"id": batch.column(0).take(pa.array(places)), "cluster": pa.array(cluster, pa.int32())}
                if last:
                    distance = np.square(x - s.centroids[cluster]).sum(1)
                    np.add.at(totals[:, dims + _HIGH], cluster, distance >> 32)
                    np.add.at(totals[:, dims + _LOW], cluster, distance & 0xFFFFFFFF)
                    yield out(len(x), **found, distance=pa.array(distance))
                else:
                    yield out(len(x), **found, x=packed(x.astype(np.int32)), upper=pa.array(upper), lower=pa.array(lower))
        if kinds:
            yield out(k, key=pa.array(np.arange(k), pa.int32()), value=packed(totals), upper=pa.array(radii))

    return source.mapInArrow(run, schema)


def _totals(table: DataFrame, k: int, dims: int) -> Totals:
    parts = table.where("key IS NOT NULL").select("key", "value", "upper")
    sums = [np.zeros(dims + 4, np.int64)] * k
    for key, value in added_up(parts, np.int64):
        sums[key] = value
    radii = np.zeros(k)
    for r in parts.groupBy("key").agg(F.max("upper").alias("radius")).collect():
        radii[r.key] = r.radius
    rows = [[int(v) for v in row] for row in sums]
    tail = lambda at: [row[dims + at] for row in rows]
    return Totals([row[:dims] for row in rows], tail(_SIZE), [(h << 32) + l for h, l in zip(tail(_HIGH), tail(_LOW), strict=True)], radii, tail(_SCANNED)[0])


@dataclass(frozen=True)
class Clusters:
    """``rows``: id, cluster and squared distance of every vector. ``centroids``: cluster, its centroid
    (array of long), ``size`` and ``inertia``, a row each (``inertia`` is null beyond a long).
    ``scanned``: rows compared with all centroids in each pass; the first compares all."""

    rows: DataFrame
    centroids: DataFrame
    inertia: int
    scanned: list[int]


def cluster(rows: DataFrame, scratch: Scratch, k: int = 16, rounds: int = 3, seed: int = 1, scale: int = 64, dims: int = 64,
            id_col: str = "vec_id", vector_col: str = "embedding") -> Clusters:
    """``rounds`` times assign and move, then assign once more."""
    spark = rows.sparkSession
    source = rows.select(column(id_col).alias("id"), column(vector_col).cast("array<double>").alias("v"))
    centroids = first_centroids(source, k, seed, scale, dims)
    state, scanned, before = State(centroids), [], None
    small = T.StructType.fromDDL("cluster int, centroid array<long>, size long, inertia long")
    if not len(centroids):
        schema = T.StructType([T.StructField(id_col, source.schema["id"].dataType), *T.StructType.fromDDL("cluster int, distance long").fields])
        return Clusters(spark.createDataFrame([], schema), spark.createDataFrame([], small), 0, [])
    for turn in range(rounds + 1):
        part = Scratch(spark, f"assigned-{turn}", scratch.root)
        table = part.write(_pass(source, state, dims, scale, last=turn == rounds), "rows")
        totals = _totals(table, len(state.centroids), dims)
        scanned.append(totals.scanned)
        if before:
            before.delete()  # its table has been read
        before = part
        if turn < rounds:
            moved = [[s // n for s in row] if n else old.tolist() for row, n, old in zip(totals.sums, totals.sizes, state.centroids, strict=True)]
            state = State(np.array(moved, np.int64), state.centroids, totals.radii)
            source = table.where("key IS NULL").select("id", "x", "cluster", "upper", "lower")
    found = table.where("key IS NULL").select(F.col("id").alias(id_col), "cluster", "distance")
    fits = [v if v < 1 << 63 else None for v in totals.inertia]
    last = [(c, [int(v) for v in x], totals.sizes[c], fits[c]) for c, x in enumerate(state.centroids)]
    return Clusters(found, spark.createDataFrame(last, small), sum(totals.inertia), scanned)
