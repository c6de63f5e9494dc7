import zlib

import numpy as np

from gridcube.llm import queries
from gridcube.llm import sharding as H
from tests.conftest import SF_SMALL


def test_matrix_has_exact_rows_and_columns():
    sizes = [0, 5, 1000, 3, 77, 1]
    m = H.communication_matrix(sizes, 24, seed=4)
    assert m.sum(1).tolist() == sizes and (m >= 0).all()
    assert set(m.sum(0)) <= {sum(sizes) // 24, sum(sizes) // 24 + 1}


def test_large_population_sampler_has_the_right_moments():
    rng = np.random.default_rng(1)
    good, bad, n = 3 * 10 ** 9, 9 * 10 ** 9, 2 * 10 ** 6
    x = np.array([H.hypergeometric(rng, good, bad, n) for _ in range(3000)])
    sd = np.sqrt(n * 0.25 * 0.75)
    assert abs(x.mean() - n / 4) < 4 * sd / np.sqrt(3000) and 0.95 < x.std() / sd < 1.05
    assert H.hypergeometric(rng, good, bad, 0) == 0


def test_shards_are_even_gapless_and_whole(spark):
    docs = spark.range(0, 5003, 1, 7).selectExpr("id as doc_id", "if(id % 3 = 0, null, 'same') as text", "1 as shard", "'s' as slot")
    got = H.shard(docs, 24).toPandas()
    assert len(got) == 5003 and sorted(got.doc_id) == list(range(5003))
    sizes = got.groupby("shard").size()
    assert len(sizes) == 24 and sizes.max() - sizes.min() <= 1
    assert all(sorted(g) == list(range(len(g))) for _, g in got.groupby("shard").slot)
    assert abs(np.corrcoef(got.doc_id, got.shard)[0, 1]) < 0.06 and abs(np.corrcoef(got.doc_id, got.slot)[0, 1]) < 0.06


def test_assignment_is_uniform(spark):
    docs = spark.range(0, 12, 1, 3).toDF("doc_id")
    seen = np.zeros((12, 3))
    for seed in range(40):
        for r in H.shard(docs, 3, seed).collect():
            seen[r.doc_id, r.shard] += 1
    expected = 40 / 3
    assert ((seen - expected) ** 2 / expected).sum() < 60        # 24 degrees of freedom: 99.99 %


def test_small_blocks_few_rows_and_none(spark, monkeypatch):
    monkeypatch.setattr(H, "BLOCK", 16)
    got = H.shard(spark.range(0, 500, 1, 2).toDF("doc_id"), 24).toPandas()
    assert sorted(got.doc_id) == list(range(500)) and got.groupby("shard").size().isin([20, 21]).all()
    few = H.shard(spark.range(3).toDF("doc_id"), 24).toPandas()
    assert len(few) == 3 and (few.slot == 0).all() and few.shard.nunique() == 3
    assert H.shard(spark.range(0).toDF("doc_id"), 24).count() == 0


def test_repeated_null_rows(spark):
    docs = spark.createDataFrame([(None, None)] * 50, "doc_id long, text string")
    got = H.shard(docs, 4).toPandas()
    assert got.groupby("shard").size().isin([12, 13]).all()


def test_query_places_whole_documents(spark, monkeypatch):
    given, made = [], []
    plain = H.shard
    monkeypatch.setattr(queries.sharding, "shard", lambda docs, *a: given.append(docs) or made.append(plain(docs, *a)) or made[-1])
    got = queries.op4_sharding(spark, SF_SMALL)
    docs = queries.table(spark, SF_SMALL, "documents")
    assert given[0].dtypes == docs.dtypes and made[0].columns == [*docs.columns, "shard", "slot"]
    assert "text" in spark.read.parquet(*got.inputFiles()).columns        # read from written shards
    want = {(r.doc_id, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in docs.collect()}
    assert {(r.doc_id, r.size, r.text_crc32) for r in got.collect()} == want and got.count() == docs.count()


def test_whole_rows_cross_one_exchange_only(spark):
    docs = spark.range(0, 900, 1, 4).selectExpr("id as doc_id", "repeat(cast(id as string), 50) as text")
    got = H.shard(docs, 24)
    assert got.where("text != repeat(cast(doc_id as string), 50)").count() == 0 and got.count() == 900
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert not [w for w in windows if "__block" in w]


def test_written_shards_are_folders_in_slot_order(spark):
    import glob

    import pyarrow.parquet as pq

    from gridcube.llm import sharding as S
    docs = spark.range(5000).selectExpr("id as doc_id", "concat('t', id) as text").repartition(6)
    t = S.write(docs, 7, seed=3)
    files = [f.removeprefix("file:").replace("file://", "") for f in t.inputFiles()]
    assert {f.split("shard=")[1].split("/")[0] for f in files} == {str(i) for i in range(7)}
    for f in files:
        slots = pq.ParquetFile(f).read().column("slot").to_pylist()
        assert slots == list(range(slots[0], slots[0] + len(slots)))           # a run without gaps
    rows = t.collect()
    assert sorted(r.doc_id for r in rows) == list(range(5000))
    assert sorted((r.shard, r.slot) for r in rows) == sorted((s, i) for s in range(7) for i in range(5000 // 7 + (s < 5000 % 7)))
    assert glob.glob(files[0])
