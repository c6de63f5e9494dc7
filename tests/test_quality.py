import pytest
from pyspark.sql import functions as F

from gridcube.operators import quality as Q


def _by(df, key="source"):
    return {r[key]: r for r in df.collect()}


def test_unique_key_and_planted_duplicate(spark):
    good = spark.createDataFrame([("a",), ("b",)], "district string")
    dup = spark.createDataFrame([("a",), ("a",), ("b",)], "district string")
    r = _by(Q.unique_key({"good": good, "dup": dup}, ["district"]))
    assert r["good"].passed and (r["dup"].duplicate_keys, r["dup"].rows, r["dup"].passed) == (1, 3, False)


def test_row_preservation_detects_fan_out(spark):
    base = spark.createDataFrame([("a",), ("b",)], "k string")
    right = spark.createDataFrame([("a", 1), ("a", 2)], "k string, v long")
    r = Q.row_preservation(base, base.join(right, "k", "left"), "fan").first()
    assert (r.base_rows, r.result_rows, r.passed) == (2, 3, False)


def test_referential_and_null_blank(spark):
    canon = spark.createDataFrame([("a",), ("b",)], "district string")
    src = spark.createDataFrame([("a",), ("Total",), (None,), ("  ",)], "district string")
    ref = Q.referential({"s": src}, canon, "district").first()
    assert ref.orphan_keys == 2 and ref.first_orphan == "  " and not ref.passed
    nb = Q.null_blank({"s": src}, "district").first()
    assert (nb.null_keys, nb.blank_keys, nb.passed) == (1, 1, False)


def test_rowcount_reconcile_one_sided(spark):
    a = spark.createDataFrame([(1,), (1,)], "x long")
    r = _by(Q.rowcount_reconcile({"t": a, "only_raw": a}, {"t": a.distinct()}))
    assert (r["t"].raw_rows, r["t"].clean_rows, r["t"].diff) == (2, 1, 1)
    assert r["only_raw"].clean_rows is None and not r["only_raw"].passed


def test_coverage_gap(spark):
    base = spark.createDataFrame([("a",), ("b",), ("c",)], "district string")
    side = spark.createDataFrame([("a",)], "district string")
    r = Q.coverage_gap(base, {"side": side}, "district").first()
    assert (r.base_keys, r.missing, r.covered) == (3, 2, 1)


def test_rebuild_match(spark):
    a = spark.createDataFrame([(1, 2.0), (1, 2.0), (2, None)], "k long, v double")
    b = spark.createDataFrame([(2, None), (1, 2.0), (1, 2.0)], "k long, v double")
    c = spark.createDataFrame([(2, None), (1, 2.0)], "k long, v double")
    assert Q.rebuild_match(a, b).first().passed
    r = Q.rebuild_match(a, c).first()
    assert (r.a_minus_b, r.b_minus_a, r.passed) == (1, 0, False)


def test_tolerance_diff(spark):
    s = spark.createDataFrame([("a", 1.0, 5), ("b", None, 6)], "k string, x double, n long")
    f = spark.createDataFrame([("a", 1.0000001, 5), ("b", None, 7)], "k string, x double, n long")
    r = _by(Q.tolerance_diff(s, f, ["k"], rtol=1e-6), "column")
    assert r["x"].passed and r["x"].mismatches == 0
    assert not r["n"].passed and r["n"].max_abs_diff == 1.0


def test_rollup_reconcile(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("Total", 3), ("total ", 0)], "district string, v long")
    r = Q.rollup_reconcile(df.where("district <> 'total '"), "district", ["v"]).first()
    assert (r.detail_sum, r.rollup_value, r.passed) == (3, 3, True)


def test_tree_diff_names_planted_rows_and_leaves_equal_tables(spark, monkeypatch):
    monkeypatch.setattr(Q, "LEAF_ROWS", 40)
    monkeypatch.setattr(Q, "TREE_BITS", 3)
    a = spark.range(3000).selectExpr("id", "id % 7 as g", "cast(id as double) / 3 as v", "concat('t', id) as t")
    rows, info = Q.tree_diff(a, a.orderBy("v").repartition(5), ["id"])
    assert info["ranges"] == 0 and info["levels"] == 1 and rows.collect() == []
    b = a.where("id <> 77").withColumn("v", F.when(F.col("id") == 1234, 0.5).otherwise(F.col("v"))).unionByName(a.where("id = 5"))
    rows, info = Q.tree_diff(a, b, ["id"])
    assert info["levels"] > 1 and info["rows_compared"] < 200
    got = sorted((r.id, r.v, r.n_a, r.n_b) for r in rows.collect())
    assert got == sorted([(77, 77 / 3, 1, 0), (1234, 1234 / 3, 1, 0), (1234, 0.5, 0, 1), (5, 5 / 3, 1, 2)])


def test_tree_diff_of_nulls_zeros_and_empty_tables(spark):
    a = spark.createDataFrame([(None, 0.0), (None, None), (1, -0.0), (1, float("nan"))], "k long, v double")
    b = spark.createDataFrame([(1, 0.0), (1, float("nan")), (None, -0.0), (None, None)], "k long, v double")
    assert Q.tree_diff(a, b, ["k"])[0].collect() == [] and Q.rebuild_match(a, b).first().passed
    assert [r.n_a for r in Q.tree_diff(a, b.limit(0), ["k"])[0].collect()] == [1, 1, 1, 1]
    empty = Q.rebuild_match(a.limit(0), b.limit(0)).first()
    assert empty.passed and (empty.rows_a, empty.rows_b) == (0, 0)
    with pytest.raises(ValueError):
        Q.tree_diff(a, b.withColumnRenamed("v", "w"))


def test_tree_diff_where_everything_differs(spark, monkeypatch):
    monkeypatch.setattr(Q, "TREE_BUCKETS", 10)
    monkeypatch.setattr(Q, "LEAF_ROWS", 5)
    a = spark.range(400).selectExpr("id", "1 as v")
    rows, _ = Q.tree_diff(a, a.withColumn("v", F.lit(2)), ["id"])
    assert rows.count() == 800
