"""Embedding whitening by spectral divide and conquer.

The covariance is summed on the cluster (exact sums first, then centred
products), so only d x d numbers reach the driver, whatever the rows. There its
eigenvectors come from QDWH: the polar factor U of V - s I, found by dynamically
weighted Halley steps, gives the projector (U + I) / 2 on the eigenvalues above
s; orthonormal bases of both sides split the matrix, and each half is split
again until single components are left. The whitening matrix, d x k numbers,
goes out with the tasks that project the rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EPS = np.finfo(float).eps
SCALE, SHIFT = 64, 1_000_000
BIG = float(1 << 62)


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix by QDWH."""
    n, alpha = len(a), np.linalg.norm(a)
    x = a / alpha
    # a lower bound of the smallest singular value, from the inverse's norm
    r = np.linalg.qr(x, mode="r")
    small = np.abs(np.diag(r)).min()
    low = max(1 / np.linalg.norm(np.linalg.inv(r)) if small > EPS * EPS else 0.0, EPS)
    for _ in range(40):
        z = min(low * low, 1.0)
        d = np.cbrt(4 * (1 - z) / (z * z))
        h = np.sqrt(1 + d) + 0.5 * np.sqrt(8 - 4 * d + 8 * (2 - z) / (z * np.sqrt(1 + d)))
        b = (h - 1) ** 2 / 4
        c = h + b - 1
        if c > 100:
            q = np.linalg.qr(np.vstack([np.sqrt(c) * x, np.eye(n)]))[0]
            y = b / c * x + (h - b / c) / np.sqrt(c) * (q[:n] @ q[n:].T)
        else:
            w = np.linalg.cholesky(np.eye(n) + c * (x.T @ x))
            y = b / c * x + (h - b / c) * np.linalg.solve(w.T, np.linalg.solve(w, x.T)).T
        y = (y + y.T) / 2
        moved, x = np.linalg.norm(y - x), y
        low = min(1.0, low * (h + b * z) / (1 + c * z))
        if abs(1 - low) < 10 * EPS and moved < np.cbrt(EPS) / 8:
            break
    return x


def _split(a: np.ndarray, rng):
    """Orthonormal bases of the eigenspaces on either side of a shift, or None
    where the matrix is a multiple of the identity to rounding."""
    n, diag = len(a), np.sort(np.diag(a))
    if np.linalg.norm(a - np.mean(diag) * np.eye(n)) <= 4 * n * EPS * np.linalg.norm(a):
        return None
    low = np.linalg.norm(a - np.mean(diag) * np.eye(n))
    # the mean of the eigenvalues always lies between the outer ones, the median splits more evenly
    for s in (np.median(diag), np.mean(diag), *(np.mean(diag) + low / n * f for f in (0.31, -0.31, 0.11, -0.11, 0.03, -0.03))):
        m = a - s * np.eye(n)
        if np.linalg.norm(m) == 0:
            continue
        p = (polar(m) + np.eye(n)) / 2
        k = int(round(np.trace(p)))
        if not 0 < k < n or np.linalg.norm(p @ p - p) > 1e-8:
            continue
        both = np.hstack([p @ rng.normal(size=(n, k)), (np.eye(n) - p) @ rng.normal(size=(n, n - k))])
        v = np.linalg.qr(both)[0]
        v = np.linalg.qr(np.hstack([p @ v[:, :k], v[:, k:] - p @ v[:, k:]]))[0]
        if np.linalg.norm(v[:, :k].T @ a @ v[:, k:]) <= 1e3 * n * EPS * np.linalg.norm(a):
            return v[:, :k], v[:, k:]
    return None


def eigen(a: np.ndarray, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, falling; unit eigenvectors as columns) of a symmetric matrix."""
    rng = np.random.default_rng(seed)

    def below(m):
        if len(m) == 1:
            return np.eye(1)
        halves = _split(m, rng)
        if halves is None:
            return np.eye(len(m)) if np.linalg.norm(m - np.diag(np.diag(m))) <= 4 * len(m) * EPS * np.linalg.norm(m) else _jacobi(m)
        return np.hstack([h @ below((lambda x: (x + x.T) / 2)(h.T @ m @ h)) for h in halves])

    if not len(a):
        return np.empty(0), np.empty((0, 0))
    scale = np.abs(a).max() or 1.0
    v = below((a + a.T) / (2 * scale))
    v = np.linalg.qr(v)[0] * 1.0
    e = np.einsum("ij,ik,kj->j", v, a, v)
    order = np.argsort(-e, kind="stable")
    return e[order], v[:, order]


def _jacobi(a: np.ndarray) -> np.ndarray:
    """Eigenvectors of a block whose eigenvalues no shift tells apart."""
    a, v = a.copy(), np.eye(len(a))
    for _ in range(30):
        if np.linalg.norm(a - np.diag(np.diag(a))) <= EPS * np.linalg.norm(a):
            break
        for i in range(len(a)):
            for j in range(i + 1, len(a)):
                if a[i, j]:
                    t = 0.5 * np.arctan2(2 * a[i, j], a[i, i] - a[j, j])
                    g = np.array([[np.cos(t), -np.sin(t)], [np.sin(t), np.cos(t)]])
                    a[:, [i, j]] = a[:, [i, j]] @ g
                    a[[i, j]] = g.T @ a[[i, j]]
                    v[:, [i, j]] = v[:, [i, j]] @ g
    return v


@dataclass
class Whitening:
    n: int
    sums: list[int]                 # exact, one a dimension
    values: np.ndarray              # eigenvalues kept, falling
    vectors: np.ndarray             # d x k
    total: float                    # the covariance's trace
    error: float                    # largest entry of the whitened covariance minus the identity

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n: whole parts subtract exactly, the fraction is what is left."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        part = np.array([float(Decimal(s % self.n) / self.n) for s in self.sums])
        return (x - whole) - part

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / np.sqrt(self.values)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """sum((n x - S)^2), exactly; None beyond a long."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n for s in self.sums], object)
        d = x - whole
        most = (float(np.abs(d).max()) + 1) * self.n if x.size else 0.0
        if most * most * max(1, x.shape[1]) < BIG:
            y = d * self.n - rest.astype(np.int64)
            return (y * y).sum(axis=1).tolist()
        y = d.astype(object) * self.n - rest
        return [v if v < 1 << 63 else None for v in (y * y).sum(axis=1).tolist()]


def usable(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, c array<double>) of the rows that take part: the vector is there and
    holds neither NULL, nor anything but finite numbers, nor one whose scaled
    value no long holds."""
    c = F.col(f"`{vector_col}`").cast("array<double>")
    return rows.select(F.col(f"`{id_col}`").alias("id"), c.alias("c")).where(
        F.col("c").isNotNull() & F.forall("c", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(BIG / SCALE))))


def _x(column, d: int) -> np.ndarray:
    c = column.flatten().to_numpy(zero_copy_only=False)
    return np.floor(SCALE * c).astype(np.int64).reshape(-1, d) + SHIFT


def _cells(rows: DataFrame, d: int, centred) -> np.ndarray:
    """The k x k sum of outer products of ``centred(x)``: a partition adds up its
    own rows, the cells are added up by Spark. Decimal cells make the sum the
    same in any order."""
    def run(batches):
        total = None
        for b in batches:
            if b.num_rows:
                w = centred(_x(b.column(0), d))
                total = w.T @ w if total is None else total + w.T @ w
        if total is not None:
            at = np.triu_indices(len(total))
            yield pa.RecordBatch.from_arrays([pa.array(at[0], pa.int32()), pa.array(at[1], pa.int32()), pa.array(total[at])], names=["i", "j", "v"])

    sums = rows.select("c").mapInArrow(run, "i int, j int, v double") \
        .groupBy("i", "j").agg(F.sum(F.expr("try_cast(v AS decimal(38,12))")).cast("double").alias("exact"), F.sum("v").alias("v"),
                               F.count_if(F.expr("try_cast(v AS decimal(38,12)) IS NULL")).alias("lost")).collect()
    k = 1 + max(r.j for r in sums)
    out = np.zeros((k, k))
    for r in sums:                               # k (k + 1) / 2 numbers, whatever the input
        out[r.i, r.j] = out[r.j, r.i] = r.v if r.lost or r.exact is None else r.exact
    return out


def fit(rows: DataFrame, k: int = 32) -> Whitening | None:
    """The whitening of ``usable`` rows of one dimension, with up to ``k``
    components; an eigenvalue that is zero to rounding gives none. None
    where there is no row."""
    d = rows.agg(F.max(F.size("c"))).first()[0]
    if not d:
        return None

    def add(batches):
        n, high, low = 0, np.zeros(d, np.int64), np.zeros(d, np.int64)
        for b in batches:
            if b.num_rows:
                x = _x(b.column(0), d)
                n, high, low = n + len(x), high + (x >> 32).sum(axis=0), low + (x & 0xFFFFFFFF).sum(axis=0)
        if n:
            s = [Decimal(int(h) * (1 << 32) + int(v)) for h, v in zip(high, low)]
            yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()), pa.array(s, pa.decimal128(38, 0))],
                                             names=["i", "n", "s"])

    sums = rows.select("c").mapInArrow(add, "i int, n long, s decimal(38,0)").groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")) \
        .orderBy("i").collect()
    model = Whitening(sums[0].n, [int(r.s) for r in sums], np.empty(0), np.empty((d, 0)), 0.0, 0.0)
    v = _cells(rows, d, model.centred) / model.n
    values, vectors = eigen(v)
    real = int((values > 16 * d * EPS * max(values[0], 0.0)).sum()) if values[0] > 0 else 0
    model.values, model.vectors, model.total = values[:min(k, real)], vectors[:, :min(k, real)], float(np.trace(v))
    if len(model.values):
        # whitened values are projections of x - S/n, so their mean is zero already
        model.error = float(np.abs(_cells(rows, d, model.project) / model.n - np.eye(len(model.values))).max())
    return model


def whiten(rows: DataFrame, k: int = 32, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """A row per usable vector and component (from 1): id_col, component, n,
    deviation, whitened, explained, identity_error.

    Vectors that are NULL or hold NULL, NaN or infinities take no part; nor do
    those of another length than the longest, for which no covariance is defined
    (empty vectors and an empty table give no rows). Repeated rows count and come
    back as often as they are there; tied eigenvalues get some orthonormal basis of
    their space; dimensions without variance give no component. Other columns are not read."""
    names = [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"]
    found = usable(rows, id_col, vector_col)
    schema = found.select(F.col("id").alias(id_col), F.lit(0).alias("component"), F.lit(0).cast("long").alias("n"), F.lit(None).cast("long").alias("deviation"),
                          F.lit(0.0).alias("whitened"), F.lit(0.0).alias("explained"), F.lit(0.0).alias("identity_error")).schema
    longest = found.agg(F.max(F.size("c"))).first()[0] or 0
    found = found.where(F.size("c") == longest)
    model = fit(found, k) if longest else None
    if model is None or not len(model.values):
        return rows.sparkSession.createDataFrame([], schema)
    k, share = len(model.values), model.values / model.total

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                b = whole.slice(at, 2048)
                x, m = _x(b.column(1), longest), b.num_rows
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                     pa.array(np.full(m * k, model.n), pa.int64()), pa.array(model.deviation(x), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                     pa.array(model.project(x).ravel()), pa.array(np.tile(share, m)), pa.array(np.full(m * k, model.error))], names=names)

    return found.mapInArrow(run, schema)
