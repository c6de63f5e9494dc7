import random

import numpy as np
import pytest

from gridcube.operators import inversions as I


def brute(cells):
    return {k: sum(c1 * c2 for p, x1, y1, c1 in cells if p == k for q, x2, y2, c2 in cells if q == k and x1 < x2 and y1 < y2) for k in {c[0] for c in cells}}


@pytest.mark.parametrize("leaf,fan,partitions", [(16, 6, 4), (3, 2, 4), (2, 1, 9), (1, 3, 2), (0, 2, 5)])
def test_against_all_pairs(spark, leaf, fan, partitions):
    rnd = random.Random(leaf * 10 + fan)
    cells = {}
    for _ in range(400):
        k = rnd.choice([0, 0, 0, 2])
        # one x and one y value hold much of everything
        cells[k, float(rnd.choice([5] * 8 + list(range(30)))), float(rnd.choice([7] * 8 + list(range(40))))] = rnd.choice([1, 2, 1000])
    rows = [(*k, c) for k, c in cells.items()]
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(rows, "pair long, x double, y double, c long")
        got = {r.pair: int(r.p) for r in I.concordant(df, leaf, fan).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == brute(rows)


def test_blocks_are_exact_and_weights_do_not_overflow(spark):
    n = 4000
    df = spark.range(n).selectExpr("1L as pair", "cast(id as double) x", "cast(id as double) y", "3000000000L as c")
    placed = I.places(df, "pair", [df.y], "b")
    sizes = [r["count"] for r in placed.selectExpr("shiftright(b, 8) as block").groupBy("block").count().collect()]
    assert max(sizes) == 256 and sorted(r.b for r in placed.collect()) == list(range(n))
    assert int(I.concordant(df, 8, 2).first().p) == n * (n - 1) // 2 * 3000000000 ** 2


def test_kernel_and_empty_input(spark):
    rng = np.random.default_rng(0)
    v, c = rng.integers(0, 9, 60), rng.integers(1, 5, 60)
    assert I.dominance(v, c) == sum(int(c[i] * c[j]) for i in range(60) for j in range(i) if v[j] < v[i])
    assert I.dominance(v[:0], c[:0]) == 0
    assert I.concordant(spark.createDataFrame([], "pair long, x double, y double, c long")).collect() == []
