import numpy as np
import pytest
from pyspark.sql import functions as F

from gridcube.llm import quality as Y
from gridcube.llm import queries as Q


def test_statistics_of_small_texts():
    s = dict(zip(Y.STATISTICS, Y.statistics("AB cd 12!\nab | é".encode())))
    n = len("AB cd 12!\nab | é".encode())
    assert s["upper"] == pytest.approx(2 / n) and s["lower"] == pytest.approx(4 / n) and s["digit"] == pytest.approx(2 / n)
    assert s["bar"] == s["bang"] == s["line"] == pytest.approx(1 / n) and s["wide"] == pytest.approx(2 / n)
    assert s["type_share"] == 1 and s["capitals"] == pytest.approx(1 / 6)
    assert Y.statistics(None) == Y.statistics(b"") == [0.0] * len(Y.STATISTICS)


def test_pool_adjacent_is_the_isotonic_fit():
    rng = np.random.default_rng(0)
    for _ in range(20):
        v, w = rng.random(9), rng.random(9) + 0.1
        got = Y.pool_adjacent(v, w)
        assert (np.diff(got) >= -1e-12).all()
        # max-min formula of isotonic regression
        mean = lambda i, j: np.average(v[i:j + 1], weights=w[i:j + 1])
        want = [max(min(mean(i, j) for j in range(k, 9)) for i in range(k + 1)) for k in range(9)]
        assert got == pytest.approx(want)


def test_features_approximate_a_gaussian_kernel():
    k = len(Y.STATISTICS)
    m = Y.Model(np.zeros(k), np.ones(k), np.zeros(Y.FEATURES + 1), np.zeros(1), np.zeros(1))
    x = np.random.default_rng(1).normal(size=(40, k))
    z = m.features(x)[:, :-1]
    exact = np.exp(-((x[:, None] - x[None]) ** 2).sum(2) / (2 * Y.WIDTH ** 2))
    assert np.abs(z @ z.T - exact).mean() < 0.06


def test_partition_sums_equal_one_solve(spark):
    docs = spark.createDataFrame([(i, ("GOOD text with words " if i % 3 else "### $$ %% ") * (i % 7 + 1)) for i in range(200)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 3 != 0 as int) as quality")
    stats = Y.with_statistics(docs)
    a, b = (Y.fit(stats.repartition(n), labels, F.lit(True)) for n in (1, 6))
    x = np.array([r.stats for r in stats.orderBy("id").collect()])
    assert a.ridge(x) == pytest.approx(b.ridge(x), abs=1e-6)
    z, y = a.features(x), np.array([float(i % 3 != 0) for i in range(200)])
    w = np.linalg.solve(z.T @ z + Y.RIDGE * 200 / Y.FEATURES * np.diag([1.0] * Y.FEATURES + [1e-9]), z.T @ y)
    assert z @ w == pytest.approx(z @ a.weights, abs=1e-6)
    p = a.probability(x)
    assert p[y == 1].min() > 0.7 and p[y == 0].max() < 0.3


def test_edge_rows_and_missing_labels(spark):
    docs = spark.createDataFrame([(1, None, "x"), (1, None, "x"), (2, "", "x"), (None, "AB cd", None), (3, "w " * 50_000, "x")], "doc_id long, text string, stats string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 0), (3, None)], "doc_id long, quality int")
    stats = Y.with_statistics(docs)
    model = Y.fit(stats, labels, F.lit(True))
    got = Y.score(stats, model).collect()
    assert len(got) == 5 and all(0 <= r.quality <= 1 for r in got)
    assert Y.score(stats.limit(0), model).count() == 0
    for none in (labels.limit(0), labels.where("quality = 1")):
        assert len({r.quality for r in Y.score(stats, Y.fit(stats, none, F.lit(True))).collect()}) == 1


def test_query_on_the_given_tables(spark):
    got = Q.op10_quality(spark, "/root/testdata/sf0.1").toPandas()
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").toPandas()
    held = got[got.held_out].merge(labels, on="doc_id")
    pos, neg = held[held.quality == 1].score.to_numpy(), held[held.quality == 0].score.to_numpy()
    assert len(got) == got.doc_id.nunique() and (pos[:, None] > neg[None]).mean() > 0.97
    assert (pos >= 0.3).mean() > 0.98
