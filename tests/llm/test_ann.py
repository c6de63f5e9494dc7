import numpy as np
from pyspark.sql import functions as F

from gridcube.llm import ann as A
from tests.conftest import SF_CHECK


def brute(ids, vectors, queries, k=10):
    out = {}
    for q in queries:
        v = vectors[ids == q][0]
        d = np.sqrt(((vectors - v) ** 2).sum(1))
        d[ids == q] = np.inf
        near = np.lexsort((ids, d))[:k]
        out[q] = [(int(ids[i]), float(d[i])) for i in near if np.isfinite(d[i])]
    return out


def test_recall_and_exact_distances(spark, monkeypatch):
    monkeypatch.setattr(A, "BLOCK", 150)
    monkeypatch.setattr(A, "QUERY_BLOCK", 3)
    table = spark.read.parquet(f"{SF_CHECK}/embeddings.parquet")
    rows = table.collect()
    ids, vectors = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float64)
    queries = [i for i in ids if i % 50 == 0]
    want, got = brute(ids, vectors, queries), {}
    for r in A.nearest(table, F.col("id") % 50 == 0, 10).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hits = 0
    for q in queries:
        mine = sorted(got[q])
        assert [r for r, _, _ in mine] == list(range(1, 11))
        assert [(s, v) for _, v, s in mine] == sorted((s, v) for _, v, s in mine)
        for _, v, s in mine:
            assert abs(s - np.sqrt(((vectors[ids == v][0] - vectors[ids == q][0]) ** 2).sum())) < 1e-12
        hits += len({v for _, v, _ in mine} & {v for v, _ in want[q]})
    assert hits / (10 * len(queries)) >= 0.9


def test_edge_rows(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 2.0]), (3, None), (4, [0.0, 0.0]), (5, [None, 1.0]),
            (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (None, [1.0, 1.0]), (8, [1.0, 2.0, 3.0]), (0, [1.0, 0.0]), (9, [])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, score string")
    got = A.nearest(df, F.col("id").isin(0, 4, 8), 10).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in got] == [(0, 1, 1), (0, 2, 1), (0, 3, 2)]
    assert A.nearest(df.limit(0), F.col("id") == 0).count() == 0 and A.nearest(df, F.col("id") == 77).count() == 0


def test_identical_vectors_tie_by_id(spark):
    df = spark.createDataFrame([(i, [0.5, 0.5, 1.0]) for i in range(300)], "vec_id long, embedding array<float>")
    got = A.nearest(df, F.col("id") == 5, 10).orderBy("rank").collect()
    assert [r.vec_id for r in got] == [0, 1, 2, 3, 4, 6, 7, 8, 9, 10] and all(r.score == 0 for r in got)
