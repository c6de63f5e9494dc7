import math

import numpy as np
import pytest

from gridcube.llm import queries as Q
from gridcube.llm import whitening as W
from tests.conftest import SF_CHECK

SCHEMA = "vec_id long, embedding array<float>"


@pytest.mark.parametrize("d", [1, 2, 7, 40, 64])
def test_eigen_against_lapack(d):
    rng = np.random.default_rng(d)
    a = rng.normal(size=(3 * d, d)) * rng.uniform(0.01, 30, d)
    a = a.T @ a
    e, v = W.eigen(a)
    assert np.allclose(e, np.linalg.eigvalsh(a)[::-1], rtol=0, atol=1e-13 * e[0])
    assert np.abs(v.T @ v - np.eye(d)).max() < 1e-13 and np.abs(a @ v - v * e).max() < 1e-13 * e[0] * d


def test_eigen_of_ties_and_singular_matrices():
    q = np.linalg.qr(np.random.default_rng(0).normal(size=(9, 9)))[0]
    for values in ([5, 5, 5, 2, 2, 1, 1, 1, 1], [3] * 9, [0] * 9, [1e8, 1, 1e-3, 0, 0, 0, 0, 0, 0], [4, 4 - 1e-12, 1, 1, 0, 0, 0, 0, 0]):
        a = (q * np.array(values, float)) @ q.T
        e, v = W.eigen(a)
        assert np.abs(v.T @ v - np.eye(9)).max() < 1e-13
        assert np.abs(a @ v - v * e).max() <= 1e-13 * max(values) and np.allclose(e, sorted(values, reverse=True), atol=1e-13 * max(values))


def test_polar_factor():
    rng = np.random.default_rng(5)
    a = rng.normal(size=(12, 12))
    a = a + a.T
    e, v = np.linalg.eigh(a)
    assert np.allclose(W.polar(a), (v * np.sign(e)) @ v.T, atol=1e-12)


def check(rows, found):
    """``found`` (the query's rows) against plain numpy and exact integers."""
    used = [(i, c) for i, c in rows if c is not None and len(c) and all(v is not None and math.isfinite(v) for v in c)]
    x = np.array([[math.floor(64 * float(np.float32(v))) + 1000000 for v in c] for _, c in used], object)
    n, s = len(x), x.sum(axis=0)
    centred = np.array([[float(v) for v in r] for r in (x * n - s)]) / n
    e, v = np.linalg.eigh(centred.T @ centred / n)
    k = min(32, int((e > 1e-12 * e.max()).sum()))
    e, v = e[::-1][:k], v[:, ::-1][:, :k]
    w = centred @ v / np.sqrt(e)
    dev = ((x * n - s) ** 2).sum(axis=1)
    got = {}
    for r in found:
        got.setdefault((r.vec_id, r.component), []).append(r)
    assert len(found) == n * k and {r.n for r in found} == {n}
    sign = {}
    total = np.trace(centred.T @ centred / n)
    for j in range(k):
        for i, (vec, _) in enumerate(used):
            match = [r for r in got[vec, j + 1] if r.deviation == dev[i]]
            assert match
            if abs(w[i, j]) > 1e-3 and j not in sign:
                sign[j] = math.copysign(1, w[i, j] * match[0].whitened)
            assert min(abs(m.whitened - sign.get(j, 1) * w[i, j]) for m in match) < 1e-6
            assert abs(match[0].explained - e[j] / total) < 1e-9 and match[0].identity_error < 1e-9


def test_query_against_numpy(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_CHECK}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check(rows, Q.op12_whitening(spark, SF_CHECK).collect())


def test_odd_vectors(spark):
    rng = np.random.default_rng(1)
    good = [(i, [float(v) for v in rng.normal(size=3) * [1, 2, 4]] + [0.25]) for i in range(30)]      # the last has no variance
    odd = [(100, None), (101, [1.0, None, 2.0, 3.0]), (102, [1.0, float("nan"), 2.0, 3.0]), (103, [float("inf"), 1.0, 2.0, 3.0]), (None, good[0][1]), (3, good[3][1])]
    frame = spark.createDataFrame([(*r, 9, 9.0) for r in good + odd], "vec_id long, embedding array<float>, n int, whitened double")
    found = W.whiten(frame).collect()
    check(good + odd, found)
    assert {r.component for r in found} == {1, 2, 3} and all(r.vec_id not in (100, 101, 102, 103) for r in found)


def test_short_empty_and_equal_vectors(spark):
    assert W.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    assert W.whiten(spark.createDataFrame([(1, []), (2, None)], SCHEMA)).collect() == []
    assert W.whiten(spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], SCHEMA)).collect() == []       # no variance at all
    mixed = W.whiten(spark.createDataFrame([(i, [float(i), float(i * i)]) for i in range(6)] + [(9, [1.0])], SCHEMA)).collect()
    assert {r.vec_id for r in mixed} == set(range(6)) and {r.n for r in mixed} == {6}


def test_deviation_beyond_a_machine_word():
    m = W.Whitening(3, [3, 3], np.ones(2), np.eye(2), 2.0, 0.0)
    assert m.deviation(np.array([[1 << 31, 0], [1 << 33, 0]])) == [(3 * (1 << 31) - 3) ** 2 + 9 if (3 * (1 << 31) - 3) ** 2 + 9 < 1 << 63 else None, None]
    assert m.deviation(np.array([[1 << 29, 5]])) == [(3 * (1 << 29) - 3) ** 2 + 144]
