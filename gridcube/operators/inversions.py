"""Weighted dominance counts over two orders, by a merge tree of bounded blocks.

Rows carry their exact place in both orders, a and b. Two rows are told apart by
the highest digit in which their b differ, so every pair with a and b both rising
is counted at one level of a tree: its leaves are blocks of exactly
``1 << leaf_bits`` places of b, counted in one task each, and every level above
merges ``1 << fan_bits`` neighbours. A level sorts the rows by (node, a) over
range partitions and adds up, per row, the weight of the lower children that came
before; a node that spans partitions is joined through one small histogram per
partition. So a level is one shuffle of the rows, there are log(n) levels, and
neither a node nor a hot value has to fit a task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridcube.session import materialize

BIG = "decimal(38,0)"
LEAF_BITS, FAN_BITS = 16, 6


def _dot(a: np.ndarray, b: np.ndarray) -> int:
    """The exact inner product of whole numbers."""
    if len(a) and float(np.abs(a).max()) * float(np.abs(b).max()) * len(a) < 2.0 ** 62:
        return int(a @ b)
    return int((a.astype(object) * b.astype(object)).sum()) if len(a) else 0


def dominance(value: np.ndarray, c: np.ndarray) -> int:
    """Sum of c_j * c_i over pairs with j before i and value_j < value_i. Each
    such pair is counted at the highest bit in which the dense ranks differ, so
    there are log(n) passes of sorts and running sums."""
    rank, c = np.unique(value, return_inverse=True)[1], c.astype(np.int64)
    total = 0
    for bit in range(int(rank.max()).bit_length() if len(rank) else 0):
        group = rank >> (bit + 1)
        at = np.argsort(group, kind="stable")
        g, w, up = group[at], c[at], (rank[at] >> bit & 1).astype(bool)
        below = np.cumsum(np.where(up, 0, w))
        first = np.searchsorted(g, g, "left")
        below = below - np.where(first > 0, below[first - 1], 0)
        total += _dot(w[up], below[up])
    return total


def places(rows: DataFrame, key: str, order: list, out: str) -> DataFrame:
    """``rows`` with their place (from 0) in ``order`` within ``key``: the place in
    a range partition plus the rows of the key in the partitions before it."""
    by = [F.col(key), *order]
    t = materialize(rows.repartitionByRange(*by).sortWithinPartitions(*by)
                    .withColumns({"__part": F.spark_partition_id(), "__place": F.monotonically_increasing_id()}), "places")
    before = Window.partitionBy(key).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = t.groupBy(key, "__part").agg(F.min("__place").alias("__lo"), F.count(F.lit(1)).alias("__n"))
    parts = parts.select(key, "__part", "__lo", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    return t.join(parts, [key, "__part"]).select(*rows.columns, (F.col("__place") - F.col("__lo") + F.col("__off")).alias(out))


def _segments(*columns: np.ndarray) -> list[tuple[int, int]]:
    """(start, end) of the runs of equal values."""
    n = len(columns[0])
    if not n:
        return []
    change = np.zeros(n, bool)
    for c in columns:
        change[1:] |= c[1:] != c[:-1]
    edge = [0, *np.flatnonzero(change).tolist(), n]
    return list(zip(edge, edge[1:]))


def _leaves(rows: DataFrame, bits: int) -> DataFrame:
    """(pair, p): the pairs inside every leaf."""
    blocks = rows.select("pair", F.shiftright("b", bits).alias("block"), "a", "b", "c") \
        .repartition("pair", "block").sortWithinPartitions("pair", "block", "a").select("pair", "block", "b", "c")

    def run(batches):
        key, held, found = None, [], {}

        def close():
            if held:
                b, c = (np.concatenate(v) for v in zip(*held))
                found[key[0]] = found.get(key[0], 0) + dominance(b, c)
        for batch in batches:
            pair, block, b, c = (x.to_numpy(zero_copy_only=False) for x in batch.columns)
            for lo, hi in _segments(pair, block):
                if key != (pair[lo], block[lo]):
                    close()
                    key, held = (pair[lo], block[lo]), []
                held.append((b[lo:hi], c[lo:hi]))
        close()
        yield _counts(found)

    return blocks.mapInArrow(run, "pair long, p string")


def _counts(found: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([int(k) for k in found], pa.int64()), pa.array([str(v) for v in found.values()], pa.string())], names=["pair", "p"])


def _level(rows: DataFrame, shift: int, fan: int) -> DataFrame:
    """(pair, p): the pairs whose b first differ in the ``fan`` bits at ``shift``."""
    width = 1 << fan
    nodes = rows.select("pair", F.shiftright("b", shift + fan).alias("node"), "a", F.shiftright("b", shift).bitwiseAND(width - 1).alias("digit"), "c")
    nodes = nodes.repartitionByRange("pair", "node", "a").sortWithinPartitions("pair", "node", "a").select("pair", "node", "digit", "c")

    def run(batches):
        key, first, seen, found, edges = None, True, np.zeros(width, np.int64), {}, []
        part = TaskContext.get().partitionId()
        for batch in batches:
            pair, node, digit, c = (x.to_numpy(zero_copy_only=False) for x in batch.columns)
            for lo, hi in _segments(pair, node):
                here = (int(pair[lo]), int(node[lo]))
                if here != key:
                    if key is not None and first:
                        edges.append((*key, seen))
                    first, key, seen = key is None, here, np.zeros(width, np.int64)
                d, w = digit[lo:hi], c[lo:hi].astype(np.int64)
                below = np.concatenate([[0], np.cumsum(seen)[:-1]])
                found[here[0]] = found.get(here[0], 0) + _dot(w, below[d]) + dominance(d, w)
                seen = seen.copy()
                np.add.at(seen, d, w)
        if key is not None:
            edges.append((*key, seen))
        out = [(k, str(v), None, None, None) for k, v in found.items()] + [(k, None, n, part, s.tolist()) for k, n, s in edges]
        pairs, p, node, parts, hist = zip(*out) if out else ((),) * 5
        yield pa.RecordBatch.from_arrays([pa.array(pairs, pa.int64()), pa.array(p, pa.string()), pa.array(node, pa.int64()), pa.array(parts, pa.int64()),
                                          pa.array(hist, pa.list_(pa.int64()))], names=["pair", "p", "node", "part", "hist"])

    counted = materialize(nodes.mapInArrow(run, "pair long, p string, node long, part long, hist array<long>"), "merge-level")
    # a node's first and last partition and those it fills: a histogram each, in order
    edges = counted.where("p is null").select("pair", "node", "part", "hist").repartition("pair", "node").sortWithinPartitions("pair", "node", "part")

    def across(batches):
        key, before, found = None, None, {}
        for batch in batches:
            for pair, node, _, hist in zip(*(x.to_pylist() for x in batch.columns)):
                if key != (pair, node):
                    key, before = (pair, node), np.zeros(width, np.int64)
                hist = np.array(hist, np.int64)
                found[pair] = found.get(pair, 0) + _dot(hist[1:], np.cumsum(before)[:-1])
                before = before + hist
        yield _counts(found)

    return counted.where("p is not null").select("pair", "p").unionByName(edges.mapInArrow(across, "pair long, p string"))


def concordant(cells: DataFrame, leaf_bits: int = LEAF_BITS, fan_bits: int = FAN_BITS) -> DataFrame:
    """(pair, p): the weight of concordant pairs of the distinct cells (pair, x, y,
    c): x and y both smaller, weights multiplied. In the orders A = (x up, y down)
    and B = (y up, x down) these are the pairs that rise in both."""
    placed = places(cells, "pair", [F.col("x").asc(), F.col("y").desc()], "a")
    placed = materialize(places(placed, "pair", [F.col("y").asc(), F.col("x").desc()], "b").select("pair", "a", "b", "c"), "placed-cells")
    top = placed.agg(F.max("b")).first()[0] or 0
    parts, shift = _leaves(placed, leaf_bits), leaf_bits
    while top >> shift:
        parts = parts.unionByName(_level(placed, shift, fan_bits))
        shift += fan_bits
    return parts.groupBy("pair").agg(F.sum(F.col("p").cast(BIG)).alias("p"))
