"""Whitening against numpy's dense eigenvectors and exact whole-number sums."""

import math

import numpy as np
import pytest

from clickloom.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, ids string, numbers string, n int, v int"


def table(spark, vectors, ids=None):
    rows = [
        (i, None if v is None else [None if c is None else float(c) for c in v], 1, "a", "b", 1, 2)
        for i, v in zip(ids or range(len(vectors)), vectors, strict=True)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def whole(vectors):
    return np.floor(1024 * np.array(vectors, np.float32).astype(np.float64)).astype(np.int64) + 100_000


def check(got, vectors, components=8):
    """Rows of the result against a dense computation over the usable ``vectors``."""
    x = whole(list(vectors.values()))
    n, dims = x.shape
    sums = [int(s) for s in x.sum(0)]
    centred = x - x.mean(0)
    values, q = np.linalg.eigh(centred.T @ centred / n)
    values, q = values[::-1], q[:, ::-1]
    k = min(components, dims)
    assert len(got) == n * k
    by_key = {(r["vec_id"], r["component"]): r for r in got}
    assert len(by_key) == n * k
    white = np.array([[by_key[i, c]["whitened"] for c in range(1, k + 1)] for i in vectors])
    want = centred @ q[:, :k] / np.sqrt(values[:k])
    for c in range(k):
        gap = min(abs(values[c] - values[j]) for j in range(dims) if j != c) if dims > 1 else 1
        if gap > 1e-6 * values[0]:
            sign = np.sign(white[:, c] @ want[:, c])
            assert np.abs(white[:, c] - sign * want[:, c]).max() < 1e-7
    assert np.abs(white.T @ white / n - np.eye(k)).max() < 1e-9
    for row, (i, _) in zip(x.tolist(), vectors.items(), strict=True):
        r = by_key[i, 1]
        assert r["deviation"] == sum((n * v - s) ** 2 for v, s in zip(row, sums, strict=True))
        assert r["n"] == n and 0 <= r["identity_error"] < 1e-9
    for c in range(k):
        assert math.isclose(by_key[next(iter(vectors)), c + 1]["explained"], values[c] / values.sum(), rel_tol=1e-9)


@pytest.mark.parametrize("dims, n", [(64, 700), (5, 40), (1, 9), (130, 400)])
def test_against_dense(spark, dims, n):
    rng = np.random.default_rng(dims)
    scales = np.r_[4.0, 3.0, np.linspace(1, 1.2, dims)][:dims]
    vectors = (rng.standard_normal((n, dims)) * scales).astype(np.float32)
    got = whitening.whitened(table(spark, vectors.tolist()).repartition(3)).collect()
    check(got, dict(enumerate(vectors.tolist())))


def test_unusable_vectors_are_dropped(spark):
    rng = np.random.default_rng(1)
    good = {i: v for i, v in enumerate(rng.standard_normal((30, 4)).astype(np.float32).tolist())}
    bad = [None, [], [1.0, None, 2.0, 3.0], [1.0, math.nan, 1.0, 1.0], [math.inf, 0, 0, 0],
           [1e30, 0, 0, 0], [1.0, 2.0], [0.0] * 9]
    frame = table(spark, [*bad, *good.values()], [*range(100, 100 + len(bad)), *good])
    check(whitening.whitened(frame).collect(), good)


def test_products_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_BYTES", 1000)
    vectors = np.random.default_rng(4).standard_normal((120, 12)).astype(np.float32)
    check(whitening.whitened(table(spark, vectors.tolist())).collect(), dict(enumerate(vectors.tolist())))


def test_no_variance_and_empty(spark):
    assert whitening.whitened(table(spark, [[1.0, 2.0]] * 5)).count() == 0
    assert whitening.whitened(table(spark, [[1.0, 2.0]])).count() == 0
    assert whitening.whitened(table(spark, [None, []])).count() == 0
    assert whitening.whitened(table(spark, [])).count() == 0


def test_fewer_directions_than_components(spark):
    rng = np.random.default_rng(6)
    flat = rng.integers(-40, 40, (80, 3)) @ rng.integers(-3, 4, (3, 20)) / 1024
    got = whitening.whitened(table(spark, flat.tolist())).collect()
    assert {r["component"] for r in got} == {1, 2, 3} and len(got) == 240
    assert max(r["identity_error"] for r in got) < 1e-9


def test_repeated_rows_and_null_ids(spark):
    vectors = [[1.0, 0.0], [1.0, 0.0], [0.0, 3.0], [-1.0, 0.5]]
    got = whitening.whitened(table(spark, vectors, [1, 1, None, 2])).collect()
    keys = sorted((str(r["vec_id"]), r["component"]) for r in got)
    assert keys == sorted((i, c) for i in ("1", "1", "2", "None") for c in (1, 2))


def test_exact_beyond_64_bits():
    of = whitening.Moments(10**9, [10**15, 7 * 10**14], 2**20)
    x = np.array([[2**20, 5], [10**6 + 1, 700_000]], np.int64)
    exact = [sum((of.n * int(v) - s) ** 2 for v, s in zip(row, of.sums, strict=True)) for row in x]
    assert whitening.deviations(x, of) == [e if e < 2**63 else None for e in exact]
    huge = whitening.Moments(2**30, [2**60, 2**61], 2**50)
    assert whitening.differences(x, huge).tolist() == [
        [huge.n * int(v) - s for v, s in zip(row, huge.sums, strict=True)] for row in x
    ]


@pytest.mark.parametrize("kind", ["spread", "crowded", "equal", "many"])
def test_solver(kind):
    rng = np.random.default_rng(9)
    dims = 300 if kind == "many" else 90
    q = np.linalg.qr(rng.standard_normal((dims, dims)))[0]
    values = {
        "spread": np.geomspace(1, 1e-9, dims),
        "crowded": 1 + 1e-5 * rng.random(dims),
        "equal": np.r_[np.full(12, 2.0), np.ones(dims - 12)],
        "many": rng.random(dims),
    }[kind]
    matrix = (q * values) @ q.T
    matrix = (matrix + matrix.T) / 2
    found = whitening.leading_pairs(lambda v: matrix @ v, dims)
    top = np.sort(values)[::-1][:8]
    assert np.abs(found.values - top).max() < 1e-13 * top[0] * 10
    residual = np.linalg.norm(matrix @ found.vectors - found.vectors * found.values, axis=0)
    assert residual.max() < 1e-13 * top[0]
    assert np.abs(found.vectors.T @ found.vectors - np.eye(8)).max() < 1e-13


def test_minres_solves_indefinite_systems():
    rng = np.random.default_rng(2)
    q = np.linalg.qr(rng.standard_normal((20, 20)))[0]
    matrix = (q * np.r_[np.linspace(-2, -1, 8), np.linspace(1, 3, 12)]) @ q.T
    right = rng.standard_normal((20, 3))
    right[:, 2] = 0
    x = whitening.minres(lambda v: matrix @ v, right, 20)
    assert np.abs(matrix @ x - right).max() < 1e-9 and not x[:, 2].any()
