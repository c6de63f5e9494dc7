"""Uniform shuffle into shards of exact sizes by a hypergeometric
communication matrix.

Input rows sit in logical partitions of at most ``BLOCK`` rows. The driver
draws, per partition, how many of its rows each shard gets: a multivariate
hypergeometric draw whose rows sum to the partitions' sizes and whose columns
sum to the shards' sizes. Each partition permutes its rows' positions in place
and deals the rows by those counts, the rows are exchanged once, and each shard
permutes what it got. The second permutation is made of ``SLICES`` hash slices a
shard with known offsets, so a shard is never sorted in one task. ``write`` stores
a folder a shard, whose files hold runs of slots in order.
"""

from __future__ import annotations

from math import exp, lgamma, log, sqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridcube.llm.names import by_place, named
from gridcube.session import materialize

BLOCK, SLICES = 1 << 17, 1024
PLAN_BLOCKS = 1 << 15           # blocks (4 billion rows) up to which the plan is small enough to be broadcast


def _log_ways(good: int, bad: int, n: int, k: int) -> float:
    return -(lgamma(k + 1) + lgamma(good - k + 1) + lgamma(n - k + 1) + lgamma(bad - n + k + 1))


def hypergeometric(rng, good: int, bad: int, n: int) -> int:
    """How many of n rows drawn without replacement are good. Up to 10^9 rows
    by numpy, beyond that (numpy's limit) by ratio-of-uniforms rejection."""
    if good + bad < 10 ** 9:
        return int(rng.hypergeometric(good, bad, n)) if n else 0
    lo, hi = max(0, n - bad), min(n, good)
    if lo == hi:
        return lo
    p, total = good / (good + bad), good + bad
    spread = sqrt(n * p * (1 - p) * (total - n) / (total - 1) + 0.5)
    width = 2 * sqrt(2 / exp(1)) * spread + 3 - 2 * sqrt(3 / exp(1))
    top = _log_ways(good, bad, n, min(hi, max(lo, (n + 1) * (good + 1) // (total + 2))))
    while True:
        u, v = 1 - rng.random(), rng.random()
        k = int(np.floor(n * p + 0.5 + width * (v - 0.5) / u))
        if lo <= k <= hi and 2 * log(u) <= _log_ways(good, bad, n, k) - top:
            return k


def communication_matrix(sizes: list[int], shards: int, seed: int = 0) -> np.ndarray:
    """(len(sizes), shards) counts; column sums differ by one at most."""
    rng, total = np.random.default_rng(seed), sum(sizes)
    left = [total // shards + (s < total % shards) for s in range(shards)]
    out = np.zeros((len(sizes), shards), np.int64)
    for p, n in enumerate(sizes):
        rest, pool = n, sum(left)
        for s in range(shards):
            pool -= left[s]
            out[p, s] = hypergeometric(rng, left[s], pool, rest) if s < shards - 1 else rest
            rest -= out[p, s]
            left[s] -= int(out[p, s])
    return out


def _places(block_size: int, seed: int):
    """A column function (row number, rows of its block) to the row's place, from
    1, in its block's random permutation. Only the two numbers go to Python; a
    task keeps the permutation of the block it is in."""
    kept = {}

    def place(row: pd.Series, count: pd.Series) -> pd.Series:
        at, n = row.to_numpy(np.int64), count.to_numpy(np.int64)
        out = np.empty(len(at), np.int64)
        blocks = at // block_size
        for b in np.unique(blocks):
            mine = blocks == b
            if b not in kept:
                kept.clear()
                kept[b] = np.random.default_rng([seed, int(b)]).permutation(n[mine][0])
            out[mine] = kept[b][at[mine] % block_size] + 1
        return pd.Series(out)

    return F.pandas_udf(place, "long")


def shard(docs: DataFrame, shards: int = 24, seed: int = 0) -> DataFrame:
    """Every row of ``docs`` with ``shard`` (0 to shards - 1) and ``slot``
    (gapless from 0 in its shard). Shard sizes differ by one row at most and
    every assignment of rows to slots is equally likely. Rows are dealt singly,
    equal rows too; NULLs, repeated rows and long texts need no care as no
    column decides; fewer rows than shards leave shards empty, and no rows give
    no rows. Columns of ``docs`` named shard or slot are replaced, others may have any name.

    The rows are written once to the shared checkpoint folder, so that row
    numbers, and with them the draw, survive a lost executor. The driver holds a
    row of ``shards`` numbers per ``BLOCK`` input rows (a billion rows: 7,630 of
    them, 24 draws each)."""
    rows, at = by_place(docs.drop("shard", "slot"))
    spark = docs.sparkSession
    rows = materialize(rows.select("*", F.monotonically_increasing_id().alias("__row")), "shard", codec="zstd")
    # the row number is (partition, row in it): its upper bits name a block of BLOCK rows
    rows = rows.withColumn("__block", F.shiftright("__row", BLOCK.bit_length() - 1))
    sizes = rows.groupBy("__block").count().orderBy("__block").collect()        # a row per BLOCK input rows
    deal = communication_matrix([r["count"] for r in sizes], shards, seed)
    plan = spark.createDataFrame([(r["__block"], r["count"], np.cumsum(deal[i]).tolist()) for i, r in enumerate(sizes)],
                                 "__block long, __count long, __upto array<long>")
    plan = F.broadcast(plan) if len(sizes) <= PLAN_BLOCKS else plan        # a row of some 300 bytes a block
    dealt = rows.join(plan, "__block").withColumn("__nth", _places(BLOCK, seed)("__row", "__count")) \
        .withColumn("shard", F.size(F.filter("__upto", lambda c: c < F.col("__nth")))) \
        .withColumn("__h", F.xxhash64(F.lit(seed + 1), "__row", "__row")) \
        .withColumn("__slice", F.pmod("__h", F.lit(SLICES)))
    first = F.sum("count").over(Window.partitionBy("shard").orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1))
    cells = dealt.groupBy("shard", "__slice").count().select("shard", "__slice", F.coalesce(first, F.lit(0)).alias("__first"))
    nth = F.row_number().over(Window.partitionBy("shard", "__slice").orderBy("__h", "__row"))
    if shards * SLICES <= 1 << 18:               # as many rows, whatever the input
        cells = F.broadcast(cells)
    # the exchange is by range of (shard, slice), so a task holds neighbouring slots
    return dealt.repartitionByRange("shard", "__slice").withColumn("__nth", nth).join(cells, ["shard", "__slice"]) \
        .select(*named(at), "shard", (F.col("__nth") - 1 + F.col("__first")).cast("long").alias("slot"))


def write(docs: DataFrame, shards: int = 24, seed: int = 0) -> DataFrame:
    """``shard``'s rows as a table in a folder a shard (reading one shard opens its
    files only), every file a run of slots in order."""
    return materialize(shard(docs, shards, seed), "shards", codec="zstd", partition_by=["shard"])
