"""Forward fill over range partitions: against a plain loop, with an entity that
fills many partitions, ties, NULL order values and every column type."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from gridcube.operators import clean as CL
from gridcube.operators import scan as SC


def by_loop(rows, keys, order, column):
    """Filled values by row id; rows are dicts in any order, ``order`` is total."""
    out, last = {}, {}
    for r in sorted(rows, key=lambda r: tuple((r[o] is not None, r[o] if r[o] is not None else 0) for o in order)):
        k = tuple(r[c] for c in keys)
        last[k] = r[column] if r[column] is not None else last.get(k)
        out[r["id"]] = last[k]
    return out


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_equals_a_loop(spark, partitions):
    rnd = random.Random(partitions)
    rows = [{"id": i, "k": rnd.choice([None, "a", "a", "a", "a", "b", "c"]), "t": rnd.choice([None, *range(60)]),
             "v": rnd.choice([None, None, None, float(i)]), "s": rnd.choice([None, None, f"x{i}"])} for i in range(500)]
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(rows, "id long, k string, t long, v double, s string")
        got = SC.fill_forward(df, ["v", "s"], ["k"], ["t", "id"]).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert {r.id: r.v for r in got} == by_loop(rows, ["k"], ["t", "id"], "v")
    assert {r.id: r.s for r in got} == by_loop(rows, ["k"], ["t", "id"], "s")


def test_one_entity_with_all_rows_is_spread(spark):
    df = spark.range(20000).select(F.lit(7).alias("k"), F.col("id").alias("t"), F.when(F.col("id") % 5000 == 17, F.col("id")).alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = SC.fill_forward(df, ["v"], ["k"], ["t"])
        sizes = [r["count"] for r in spark.read.parquet(*out.inputFiles()).groupBy("__part").count().collect()]
        assert len(sizes) == 4 and max(sizes) < 8000
        wrong = out.where(~F.col("v").eqNullSafe(F.when(F.col("t") >= 17, F.floor((F.col("t") - 17) / 5000) * 5000 + 17)))
        assert wrong.count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_ties_give_the_same_result_however_distributed(spark):
    rows = [(1, i % 3, None if i % 2 else float(i), i) for i in range(60)] + [(1, 1, None, 1)] * 30
    df = spark.createDataFrame(rows, "k long, t long, v double, i long")
    a, b = (sorted(map(tuple, SC.fill_forward(d, ["v"], ["k"], ["t"]).collect()), key=repr) for d in (df, df.orderBy(F.rand(3)).repartition(7)))
    assert a == b and len(a) == 90


def test_types_nan_keys_and_no_entity(spark):
    nan, d, ts = float("nan"), dt.date(2025, 1, 2), dt.datetime(2025, 1, 2, 3)
    rows = [(nan, 1, d, ts, [1], 1.5), (nan, 2, None, None, None, nan), (nan, 3, None, None, None, None), (0.0, 4, None, None, None, None)]
    df = spark.createDataFrame(rows, "k double, t int, d date, ts timestamp, a array<int>, x double")
    got = {r.t: r for r in SC.fill_forward(df, ["d", "ts", "a", "x"], ["k"], ["t"]).collect()}
    assert (got[3].d, got[3].ts, got[3].a) == (d, ts, [1]) and got[3].x != got[3].x and got[4].d is None
    whole = {r.t: r.d for r in SC.fill_forward(df, ["d"], [], ["t"]).collect()}
    assert set(whole.values()) == {d}
    assert SC.fill_forward(df.limit(0), ["d"], ["k"], ["t"]).collect() == []


def test_column_names_with_dots_and_chosen_order(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, 5), (1, 3, None)], "`a.k` long, col1 long, `v.1` long")
    assert [r["v.1"] for r in CL.fill_forward(df, ["v.1"], ["a.k"], ["col1"]).orderBy("col1").collect()] == [None, 5, 5]
    assert [r["v.1"] for r in CL.fill_forward(df, ["v.1"], ["a.k"], [F.col("col1").desc()]).orderBy("col1").collect()] == [5, 5, None]
