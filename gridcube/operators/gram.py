"""Pearson correlation of any number of columns from one scan.

Every partition adds up masked cross products of its rows: for columns i and j,
over the rows where both are present, the count, the sums of i and of j, of their
squares, and of their product. A partial is cut into blocks of matrix rows of
about ``CELLS`` cells, so the merge of each block is its own task and no task
holds a whole matrix of all partitions. Values are taken relative to a typical
value of their column in their partition; merging moves partials to a common
base, so neither large offsets nor partitions of different level cost digits.

No row is multiplied and no pair is an expression of its own: the plan is the same
for ten columns and for a thousand. A partition holds five p x p matrices
(40 MB for 1,000 columns).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructType

from gridcube.functions import exprs as X

CELLS = 4096                     # of one block of a partial
GROUP_CELLS = 1 << 22            # held for all groups of a task before it writes its partials
CONSTANT = 1e-12                 # a spread below this part of the squares is rounding


def _empty(p: int) -> list[np.ndarray]:
    """shift (p), then count, sum, squares, infinite and product (p x p): cell
    [i, j] is about column i over the rows where j is present too."""
    return [np.full(p, np.nan), *(np.zeros((p, p)) for _ in range(5))]


def _typical(x: np.ndarray) -> np.ndarray:
    """Per column the value nearest to its mean, NaN where there is none."""
    there = np.isfinite(x)
    n = there.sum(axis=0)
    with np.errstate(invalid="ignore", over="ignore"):
        mean = np.where(there, x, 0.0).sum(axis=0) / np.maximum(n, 1)
        gap = np.where(there, np.abs(x - mean), np.inf)
    at = np.argmin(gap, axis=0) if len(x) else np.zeros(x.shape[1], int)
    return np.where(n > 0, x[at, np.arange(x.shape[1])] if len(x) else np.nan, np.nan)


def add_rows(m: list[np.ndarray], x: np.ndarray) -> None:
    """Add the rows of ``x`` (NaN where missing) to a partial."""
    new = np.isnan(m[0])
    if new.any():
        m[0] = np.where(new, _typical(x), m[0])           # nothing of such a column is summed yet
    there, endless = ~np.isnan(x), np.isinf(x)
    v = np.where(there & ~endless, x - np.nan_to_num(m[0]), 0.0)
    if there.all():
        m[1] += len(x)
        m[2] += v.sum(axis=0)[:, None]
        m[3] += (v * v).sum(axis=0)[:, None]
    else:
        k = there.astype(float)
        m[1] += k.T @ k
        m[2] += v.T @ k
        m[3] += (v * v).T @ k
    m[5] += v.T @ v
    if endless.any():
        m[4] += endless.astype(float).T @ there


def pack(m: list[np.ndarray], lo: int, hi: int) -> bytes:
    """Matrix rows lo to hi with what their pairs need of the other columns."""
    return np.concatenate([m[0], *(m[i][lo:hi].ravel() for i in (1, 2, 3, 4, 5)), *(m[i][:, lo:hi].T.ravel() for i in (2, 3, 4))]).tobytes()


class Block:
    """Matrix rows lo to hi, merged from partials."""

    def __init__(self, p: int, lo: int, hi: int):
        self.p, self.lo, self.hi, self.shift, self.sums = p, lo, hi, np.full(p, np.nan), np.zeros((8, hi - lo, p))

    def add(self, packed: bytes) -> None:
        flat = np.frombuffer(packed)
        shift, sums = flat[:self.p], flat[self.p:].reshape(8, self.hi - self.lo, self.p).copy()
        self.shift = np.where(np.isnan(self.shift), shift, self.shift)
        d = np.nan_to_num(shift - self.shift)             # nothing is summed where either is missing
        own, other = d[self.lo:self.hi][:, None], d[None, :]
        n, s, q, _, c, st, qt, _ = sums
        sums[4] = c + s * other + st * own + n * own * other
        sums[2], sums[6] = q + 2 * own * s + n * own * own, qt + 2 * other * st + n * other * other
        sums[1], sums[5] = s + n * own, st + n * other
        self.sums += sums

    def cells(self):
        """(i, j, correlation or None, rows) for j >= i."""
        n, s, q, e, c, st, qt, et = self.sums
        a, b = n * q - s * s, n * qt - st * st
        ok = (a > CONSTANT * n * q) & (b > CONSTANT * n * qt) & (e + et == 0)
        with np.errstate(invalid="ignore", divide="ignore"):
            r = (n * c - s * st) / (np.sqrt(a) * np.sqrt(b))
        for i in range(self.lo, self.hi):
            for j in range(i, self.p):
                k = i - self.lo
                yield i, j, (1.0 if i == j else float(np.clip(r[k, j], -1, 1))) if ok[k, j] else None, int(n[k, j])


def correlations(df: DataFrame, columns: list[str], by: list[str] | None = None, digits: int | None = 6) -> DataFrame:
    """(*by, indicator_a, indicator_b, pos_a, pos_b, correlation, n_rows) for every
    pair of ``columns`` in their order, each column with itself included, over the
    rows where neither is NULL or NaN. Correlation is NULL where a side does not
    vary over these rows or holds an infinity; without any rows all pairs are there
    with 0 rows (with ``by``, there is no group then)."""
    by, p, spark = list(by or []), len(columns), df.sparkSession
    rows_each = max(1, CELLS // p)
    edges = [(lo, min(p, lo + rows_each)) for lo in range(0, p, rows_each)]
    most = max(1, GROUP_CELLS // (p * p))
    src = df.select(*[F.col(f"`{b}`") for b in by], *[F.col(f"`{c}`").cast("double").alias(f"__{i}") for i, c in enumerate(columns)])
    k = len(by)
    partial = StructType(src.select(*[f"`{b}`" for b in by]).schema.fields).add("__block", LongType()).add("__part", LongType()) \
        .add("__packed", "binary")
    names = [*by, "__block", "__part", "__packed"]

    def sums(batches):
        held: dict[tuple, list] = {}
        kinds = part = None

        def out():
            for key, m in held.items():
                for block, (lo, hi) in enumerate(edges):
                    yield pa.RecordBatch.from_arrays([*[pa.array([v], t) for v, t in zip(key, kinds)], pa.array([block], pa.int64()),
                                                      pa.array([part], pa.int64()), pa.array([pack(m, lo, hi)], pa.binary())], names=names)
        for b in batches:
            kinds, part = [b.schema.field(i).type for i in range(k)], TaskContext.get().partitionId()
            x = np.column_stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(k, k + p)]) if b.num_rows else np.empty((0, p))
            if not k:
                add_rows(held.setdefault((), _empty(p)), x)
                continue
            at: dict[tuple, list[int]] = {}
            for i, key in enumerate(zip(*(b.column(c).to_pylist() for c in range(k)))):
                at.setdefault(key, []).append(i)
            for key, some in at.items():
                if key not in held and len(held) >= most:
                    yield from out()
                    held = {}
                add_rows(held.setdefault(key, _empty(p)), x[some])
        yield from out()

    partials = src.mapInArrow(sums, partial)
    if not by:
        zero = [pack(_empty(p), lo, hi) for lo, hi in edges]

        def seed(batches):                                # so that an empty table has its pairs
            for b in batches:
                for i in b.column(0).to_pylist():
                    yield pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([-1], pa.int64()), pa.array([zero[i]], pa.binary())], names=names)
        partials = partials.unionByName(spark.range(len(edges)).mapInArrow(seed, partial))

    at = [*[F.col(f"`{b}`") for b in by], F.col("__block")]
    cells = StructType(partial.fields[:k]).add("indicator_a", StringType()).add("indicator_b", StringType()) \
        .add("pos_a", LongType()).add("pos_b", LongType()).add("correlation", DoubleType()).add("n_rows", LongType())

    def merge(batches):
        key = block = kinds = None

        def done():
            i, j, r, n = zip(*block.cells())
            return pa.RecordBatch.from_arrays(
                [*[pa.array([v] * len(i), t) for v, t in zip(key, kinds)], pa.array([columns[v] for v in i]), pa.array([columns[v] for v in j]),
                 pa.array(i, pa.int64()), pa.array(j, pa.int64()), pa.array(r, pa.float64()), pa.array(n, pa.int64())], names=[f.name for f in cells.fields])
        for b in batches:
            kinds = [b.schema.field(i).type for i in range(k)]
            keys = list(zip(*(b.column(i).to_pylist() for i in range(k + 1))))
            for here, packed in zip(keys, b.column(k + 2).to_pylist()):
                if block is None or here != (*key, number):
                    if block is not None:
                        yield done()
                    key, number = here[:k], here[k]
                    block = Block(p, *edges[number])
                block.add(packed)
        if block is not None:
            yield done()

    out = partials.repartition(*at).sortWithinPartitions(*at, "__part").mapInArrow(merge, cells)
    return out.withColumn("correlation", X.rnd("correlation", digits)) if digits is not None else out
