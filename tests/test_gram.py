"""Correlations from one scan, against numpy and pandas."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridcube.operators import gram as G
from gridcube.operators import stats as ST


def frame(spark, x, names, parts=5, **extra):
    pdf = pd.DataFrame(x, columns=names)
    for k, v in extra.items():
        pdf[k] = v
    return spark.createDataFrame(pdf).repartition(parts), pdf


def test_gaps_offsets_and_partitions_of_different_level(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 6)) @ rng.normal(size=(6, 6))
    x[:, 1] += 1e9
    x[:, 2] = np.sort(x[:, 2]) * 1e4                       # each partition has its own level
    x[rng.random(x.shape) < 0.3] = np.nan
    names = list("abcdef")
    pdf = pd.DataFrame(x, columns=names)
    df = spark.createDataFrame(pdf).withColumn("i", F.monotonically_increasing_id()).repartitionByRange(7, "i").drop("i")
    got = {(r.indicator_a, r.indicator_b): r for r in G.correlations(df, names, digits=None).collect()}
    want = pdf.corr()
    assert len(got) == 21
    for (a, b), r in got.items():
        both = pdf[[a, b]].dropna() if a != b else pdf[[a]].dropna()
        exact = np.corrcoef(both[a] - both[a].iloc[0], both[b] - both[b].iloc[0])[0, 1]
        assert r.n_rows == len(both) and r.correlation == pytest.approx(exact, abs=1e-9), (a, b)
        assert r.correlation == pytest.approx(want.loc[a, b], abs=1e-6)


def test_a_thousand_columns_in_one_scan(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(60, 1000))
    x[rng.random(x.shape) < 0.1] = np.nan
    names = [f"c{i}" for i in range(1000)]
    src = spark.createDataFrame(list(enumerate(x.tolist())), "i long, v array<double>").repartition(3)
    df = src.select(*[F.when(~F.isnan(F.col("v")[i]), F.col("v")[i]).alias(n) for i, n in enumerate(names)])
    out = G.correlations(df, names)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") <= 2          # the table once, and the seed's range
    m = np.full((1000, 1000), np.nan)
    for r in out.collect():
        m[r.pos_a, r.pos_b] = r.correlation
    want = pd.DataFrame(x).corr().to_numpy()
    upper = np.triu_indices(1000)
    assert np.abs(m[upper] - want[upper]).max() < 1e-6


def test_constants_infinities_and_no_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1.0, 0.1, 5.0, None, 1.0), (2.0, 0.1, 5.0, None, inf), (3.0, 0.1, 5.0, nan, 2.0), (4.0, None, 7.0, None, 3.0)]
    df = spark.createDataFrame(rows, "x double, c double, later double, none double, e double")
    names = df.columns
    got = {(r.indicator_a, r.indicator_b): (r.correlation, r.n_rows) for r in G.correlations(df, names).collect()}
    assert got["x", "c"] == (None, 3) and got["c", "c"] == (None, 3)
    assert got["c", "later"] == (None, 3) and got["later", "later"] == (1.0, 4)   # later only varies where c is missing
    assert got["x", "none"] == (None, 0) and got["x", "e"] == (None, 4) and got["x", "later"][0] == pytest.approx(0.774597)
    empty = G.correlations(df.limit(0), names).collect()
    assert len(empty) == 15 and {(r.correlation, r.n_rows) for r in empty} == {(None, 0)}


def test_groups_in_bounded_memory(spark, monkeypatch):
    """Groups beyond what a task may hold are written as several partials."""
    monkeypatch.setattr(G, "GROUP_CELLS", 8)
    rng = np.random.default_rng(6)
    x = rng.normal(size=(300, 2))
    df, pdf = frame(spark, x, ["a", "b"], month=[f"m{i % 13}" for i in range(300)])
    got = {r.month: r.correlation for r in ST.corr_pairs_listwise(df, ["a", "b"], None, by=["month"]).collect()}
    assert len(got) == 13
    for m, part in pdf.groupby("month"):
        assert got[m] == pytest.approx(part[["a", "b"]].corr().iloc[0, 1], abs=1e-12)
    assert G.correlations(df.limit(0), ["a", "b"], by=["month"]).collect() == []


def test_same_result_in_any_distribution(spark):
    rng = np.random.default_rng(8)
    df, _ = frame(spark, rng.normal(size=(500, 3)) + 1e6, ["a", "b", "c"])
    one, many = (sorted(map(tuple, G.correlations(d, ["a", "b", "c"]).collect())) for d in (df.coalesce(1), df.repartition(23)))
    assert one == many
