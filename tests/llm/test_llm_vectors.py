"""Operators 11 and 12 against brute force over small tables."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
from llm_helpers import scratch  # noqa: F401

from marketlake.llm import clustering as C
from marketlake.llm import whitening as W


def odd_vectors(spark, good: np.ndarray):
    """The good vectors, some twice and under null or repeated ids, among vectors that cannot count."""
    dims = good.shape[1]
    rows = [(i if i % 7 else None, [float(v) for v in x], "own", 1) for i, x in enumerate(good)]
    rows += [rows[1]] * 3 + [(3, rows[2][1], "own", 1)]
    bad = [None, [], [1.0], [None] * dims, [float("nan")] * dims, [0.0] * (dims - 1) + [float("-inf")], [0.0] * (dims - 1) + [None], [3e38] * dims]
    rows += [(900 + i, v, "own", 1) for i, v in enumerate(bad)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, x string, component int")


def spectrum(kind: str, n: int) -> np.ndarray:
    return {"even": np.linspace(1, 2, n), "equal": np.ones(n), "pairs": np.repeat(np.arange(n, 0, -1), 2)[:n], "steep": 10.0 ** -np.arange(n)}[kind]


@pytest.mark.parametrize("n", [1, 2, 3, 17, 64])
@pytest.mark.parametrize("kind", ["even", "equal", "pairs", "steep"])
def test_components_of_any_spectrum(n, kind):
    q, _ = np.linalg.qr(np.random.default_rng(n).normal(size=(n, n)))
    a = (q * spectrum(kind, n)) @ q.T
    a = (a + a.T) / 2
    values, vectors = W.leading_components(a, 5)
    assert np.allclose(values, np.linalg.eigvalsh(a)[::-1][:len(values)], atol=1e-13)
    assert np.abs(a @ vectors - vectors * values).max() < 1e-12
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12


def test_sturm_counts_and_split_matrices():
    d, e = np.array([1.0, 5, 2, 4]), np.zeros(3)
    assert W.below(d, e, np.array([0.5, 1.5, 4.5, 9])).tolist() == [0, 1, 3, 4]
    assert np.allclose(W.leading_eigenvalues(d, e, 4), [5, 4, 2, 1])
    values, vectors = W.leading_components(np.zeros((3, 3)), 2)
    assert values.tolist() == [0, 0] and np.allclose(vectors.T @ vectors, np.eye(2))


def whitened_by_brute_force(x: np.ndarray, k: int):
    fitted = np.unique(x, axis=0)
    values, vectors = np.linalg.eigh(np.cov(fitted.T, bias=True))
    values, vectors = values[::-1], vectors[:, ::-1]
    n, sums = len(fitted), fitted.sum(0)
    return n, ((n * x - sums) ** 2).sum(1), (x - sums / n) @ vectors[:, :k] / np.sqrt(values[:k]), values[:k] / values.sum()


def test_whitening_equals_brute_force(spark, scratch):  # noqa: F811
    good = np.random.default_rng(5).normal(size=(90, 6)).astype(np.float32) * np.arange(1, 7)
    df = odd_vectors(spark, good)
    rows = W.whiten(df, scratch, components=3).collect()
    assert rows[0].asDict().keys() == {"vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"}
    x = np.floor(256 * np.r_[good, good[[1, 1, 1, 2]]].astype(float)).astype(np.int64)
    n, deviation, projected, explained = whitened_by_brute_force(x, 3)
    assert len(rows) == len(x) * 3 and {r.n for r in rows} == {n}
    assert rows[0].identity_error < 1e-12 and len({r.identity_error for r in rows}) == 1
    for c in range(3):
        found = sorted((int(r.deviation), r.whitened) for r in rows if r.component == c + 1)
        wanted = sorted(zip(deviation.tolist(), projected[:, c], strict=True))
        assert [f[0] for f in found] == [w[0] for w in wanted]
        a, b = np.array([f[1] for f in found]), np.array([w[1] for w in wanted])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-9
        assert abs(next(r.explained for r in rows if r.component == c + 1) - explained[c]) < 1e-12


def test_whitening_of_few_dimensions_and_none(spark, scratch):  # noqa: F811
    line = np.outer(np.arange(1, 9), np.ones(5)) / 4
    rows = W.whiten(odd_vectors(spark, line), scratch).collect()
    assert {r.component for r in rows} == {1} and len(rows) == 12  # the others have no variance
    assert abs(rows[0].explained - 1) < 1e-12 and rows[0].identity_error < 1e-12
    assert W.whiten(odd_vectors(spark, np.ones((3, 5))), scratch).count() == 0
    assert W.whiten(odd_vectors(spark, line).where("vec_id >= 900 AND vec_id != 902"), scratch).count() == 0
    empty = W.whiten(odd_vectors(spark, line).limit(0), scratch)
    assert empty.count() == 0 and "whitened" in empty.columns


def test_large_deviations_are_exact():
    m = W.Whitening(2, 10 ** 9, [3 * 10 ** 9, 5], 1.0, np.empty(0), np.empty((2, 0)))
    x = np.array([[2 ** 30, -7], [1, 2]])
    assert [int(v) for v in m.deviations(x).to_pylist()] == [(10 ** 9 * int(a) - 3 * 10 ** 9) ** 2 + (10 ** 9 * int(b) - 5) ** 2 for a, b in x]


def clustered_by_brute_force(ids: list, x: np.ndarray, k: int, rounds: int):
    digests = [hashlib.sha256(f"1:{'null' if i is None else i}".encode()).hexdigest() for i in ids]
    c = x[sorted(range(len(x)), key=lambda i: (digests[i], x[i].tolist()))[:k]]
    for turn in range(rounds + 1):
        d = np.square(x[:, None, :] - c).sum(2)
        own = d.argmin(1)
        if turn < rounds:
            c = np.array([x[own == j].sum(0) // (own == j).sum() if (own == j).any() else c[j] for j in range(len(c))])
    return own, d.min(1), c


@pytest.mark.parametrize("spread, k, count", [(0.05, 5, 300), (1.0, 16, 200), (0.0, 4, 40), (0.3, 16, 9)])
def test_clusters_equal_brute_force(spark, scratch, spread, k, count):  # noqa: F811
    """Close groups, none, equal vectors (ties), and fewer rows than clusters."""
    rng = np.random.default_rng(count)
    middles = rng.integers(-3, 4, (6, 8))
    good = (middles[rng.integers(0, 6, count)] + spread * rng.normal(size=(count, 8))).astype(np.float32)
    df = odd_vectors(spark, good).repartition(3)
    found = C.cluster(df, scratch, k=k, dims=8, rounds=4)
    ids = [i if i % 7 else None for i in range(count)] + [1, 1, 1, 3]
    x = np.floor(64 * np.r_[good, good[[1, 1, 1, 2]]].astype(float)).astype(np.int64)
    own, distance, c = clustered_by_brute_force(ids, x, k, 4)
    order = lambda rows: sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, *r[1:]))
    assert order(tuple(r) for r in found.rows.collect()) == order(zip(ids, own.tolist(), distance.tolist(), strict=True))
    small = {r.cluster: r for r in found.centroids.collect()}
    assert [small[j].centroid for j in sorted(small)] == c.tolist()
    assert [small[j].inertia for j in sorted(small)] == np.bincount(own, distance, len(c)).astype(int).tolist()
    assert found.inertia == distance.sum() and [small[j].size for j in sorted(small)] == np.bincount(own, minlength=len(c)).tolist()
    if spread == 0.05:
        assert found.scanned[-1] < len(x) / 4  # the bounds decide most rows


def test_losses_hold_and_are_less_than_the_drift():
    """No point of a sphere comes nearer by more than its bound; far spheres lose less than the drift."""
    rng = np.random.default_rng(2)
    tighter = 0
    for _ in range(60):
        old = rng.integers(-200, 200, (4, 5))
        new = old + rng.integers(-40, 40, (4, 5))
        radii = rng.random(4) * 150
        found, drift = C.losses(old, new, radii), np.sqrt(np.square(new - old).sum(1))
        for i in range(4):
            step = rng.normal(size=(400, 5))
            points = old[i] + radii[i] * step / np.linalg.norm(step, axis=1)[:, None] * rng.random((400, 1)) ** 0.2
            for j in set(range(4)) - {i}:
                nearer = np.linalg.norm(points - old[j], axis=1) - np.linalg.norm(points - new[j], axis=1)
                assert nearer.max() <= found[i] + 1e-9
            tighter += found[i] < max(drift[j] for j in range(4) if j != i) * 0.999
    assert tighter > 100
    assert C.losses(np.zeros((2, 3), int), np.zeros((2, 3), int), np.ones(2)).tolist() == [0, 0]


def test_no_vectors(spark, scratch):  # noqa: F811
    df = odd_vectors(spark, np.ones((3, 8)))
    for none in (df.limit(0), df.where("vec_id >= 900")):
        found = C.cluster(none, scratch, dims=8)
        assert found.rows.count() == 0 and found.centroids.count() == 0 and found.rows.columns == ["vec_id", "cluster", "distance"]
