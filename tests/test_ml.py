import random

import pytest
from pyspark.sql import functions as F

from gridcube.operators import ml as ML


def _cube(spark, n=60, seed=1):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        d = {"District": f"D{i:03d}", "PW_Anaemia_Rate": r.uniform(20, 60), "Optimum_WG_Latest_%": r.uniform(30, 70),
             "PW_Hb_Measured_%": r.uniform(40, 90), "Measurement_Efficiency": r.uniform(50, 95),
             "HV_Percentage": r.uniform(40, 80), "SAM_Rate_%": r.uniform(1, 8), "SUW_Rate_%": r.uniform(5, 25),
             "Active_AWC_%": r.uniform(70, 100), "LBW_Rate_%": r.uniform(5, 20), "Stunting_Total_%": r.uniform(20, 50)}
        rows.append(d)
    cols = list(rows[0])
    return spark.createDataFrame([tuple(d[c] for c in cols) for d in rows],
                                 ", ".join(f"`{c}` {'string' if c == 'District' else 'double'}" for c in cols))


def test_train_frame_guard(spark):
    df = _cube(spark, 9)
    with pytest.raises(ValueError):
        ML.train_frame(df, ML.LBW_FEATURES, ML.LBW_TARGET)


def test_feature_intersection():
    class D:
        columns = ["a", "c"]
    assert ML.present_features(D, ["a", "b", "c"]) == ["a", "c"]


def test_holdout_is_deterministic_and_partition_free(spark):
    df = spark.range(2000).withColumn("t", ML.holdout_flag("id"))
    a = {r.id: r.t for r in df.collect()}
    b = {r.id: r.t for r in spark.range(2000).repartition(7).withColumn("t", ML.holdout_flag("id")).collect()}
    assert a == b and 0.25 < sum(a.values()) / 2000 < 0.35


def test_forest_importances_and_masked_scoring(spark):
    df = _cube(spark)
    feats = ML.present_features(df, ML.LBW_FEATURES)
    model = ML.fit(ML.train_frame(df, feats, ML.LBW_TARGET), feats, ML.LBW_TARGET, num_trees=20)
    imp = ML.feature_importance(spark, model, feats, "lbw").collect()
    assert abs(sum(r.importance for r in imp) - 1.0) < 1e-9
    assert [r.rank for r in imp] == list(range(1, len(feats) + 1))
    holes = df.withColumn("SAM_Rate_%", F.when(F.col("District") == "D000", F.lit(None)).otherwise(F.col("SAM_Rate_%")))
    scored = ML.score(model, holes, feats, "LBW_Predicted")
    assert scored.count() == 60
    r = {x.District: x.LBW_Predicted for x in scored.collect()}
    assert r["D000"] is None and all(v is not None for k, v in r.items() if k != "D000")


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (3.0, 4.0)], "y double, p double")
    m = ML.regression_metrics(df, "y", "p").first()
    assert m.n == 3 and m.mae == round(1 / 3, 6) and m.r2 == round(1 - 1 / 2, 6)


def test_prepare_requests(spark):
    req = spark.createDataFrame([(1, 30.0, None, 0.0), (2, None, None, None)],
                                "request_id long, PW_Anaemia_Rate double, SAM_Rate_ double, HV_Percentage double")
    out = {r.request_id: r for r in ML.prepare_requests(req, ML.LBW_FEATURES).collect()}
    assert out[1].status == "ok" and out[1].features_used == ["PW_Anaemia_Rate"]
    assert out[1]["SAM_Rate_%"] == 0.0 and out[1]["HV_Percentage"] == 0.0
    # HV_Percentage was supplied as 0 (not used, not missing); SAM_Rate_ was absent
    assert "SAM_Rate_%" in out[1].features_missing and "HV_Percentage" not in out[1].features_missing
    assert out[2].status == "no_valid_features" and out[2].features_used == []
    none = ML.prepare_requests(req.select("request_id"), ML.STUNTING_FEATURES).first()
    assert none.status == "no_valid_features"


def test_model_roundtrip_and_prediction_sink(spark, tmpdir_path):
    import os
    df = _cube(spark)
    feats = ML.present_features(df, ML.STUNTING_FEATURES)
    model = ML.fit(df, feats, ML.STUNTING_TARGET, num_trees=5)
    path = os.path.join(tmpdir_path, "models", "stunting")
    ML.save_model(model, path)
    again = ML.load_model(path)
    a = ML.score(model, df, feats, "p").select("District", "p")
    b = ML.score(again, df, feats, "p").select("District", "p")
    assert a.exceptAll(b).count() == 0
    sink = os.path.join(tmpdir_path, "predictions")
    ML.write_predictions(a.withColumn("month", F.lit("2025-11")), sink, "2025-12-05 12:17:00")
    ML.write_predictions(a.withColumn("month", F.lit("2025-11")), sink, "2025-12-06 09:00:00")
    runs = spark.read.parquet(sink).groupBy("run_ts").count().collect()
    assert sorted(r["count"] for r in runs) == [60, 60]


def test_forest_is_deterministic_and_bounded(spark):
    df = _cube(spark, 40, seed=5)
    feats = ML.present_features(df, ML.LBW_FEATURES)
    train = ML.train_frame(df, feats, ML.LBW_TARGET)
    a = ML.score(ML.fit(train, feats, ML.LBW_TARGET, num_trees=15), df, feats, "p", digits=None)
    b = ML.score(ML.fit(train, feats, ML.LBW_TARGET, num_trees=15), df, feats, "p", digits=None)
    pa = {r.District: r.p for r in a.collect()}
    assert pa == {r.District: r.p for r in b.collect()}           # same seed, same forest
    lo, hi = train.agg(F.min(f"`{ML.LBW_TARGET}`"), F.max(f"`{ML.LBW_TARGET}`")).first()
    assert all(lo - 1e-9 <= v <= hi + 1e-9 for v in pa.values())  # averages of leaf means stay in range


def test_exact_split_size_and_stability(spark):
    import hashlib
    import math

    from pyspark.sql import functions as F

    from gridcube.operators import ml as ML
    for n in (0, 1, 10, 333, 1000):
        df = spark.range(n).withColumnRenamed("id", "k")
        got = {r.k: r.is_test for r in ML.exact_split(df, "k").collect()}
        ranked = sorted(range(n), key=lambda k: hashlib.md5(str(k).encode()).hexdigest())
        assert {k for k, t in got.items() if t} == set(ranked[:math.ceil(round(0.3 * n, 9))])
    df = spark.range(1000).withColumnRenamed("id", "k")
    again = ML.exact_split(df.orderBy(F.rand(1)).repartition(9), "k")
    assert {r.k for r in again.where("is_test").collect()} == {k for k, t in got.items() if t}
    assert ML.exact_split(df, "k", 1.0).where("is_test").count() == 1000 and ML.exact_split(df, "k", 0.0).where("is_test").count() == 0


def test_exact_split_of_shared_keys_and_equal_rows(spark):
    from gridcube.operators import ml as ML
    rows = [(1, i) for i in range(50)] + [(None, 1)] * 40 + [(2, 7)] * 90
    df = spark.createDataFrame(rows, "k long, v long").repartition(5)
    for share in (0.1, 0.3, 0.5, 0.77, 0.95):
        out = ML.exact_split(df, "k", share)
        want = -(-int(round(share * 18000)) // 100)
        assert out.where("is_test").count() == want and out.count() == 180
        assert out.drop("is_test").exceptAll(df).count() == 0
