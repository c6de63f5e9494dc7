from pyspark.sql import functions as F

from gridcube.operators import clean as CL
from tests.conftest import rows


def test_basic_clean_trims_dedupes_and_normalises(spark):
    df = spark.createDataFrame([("  Khordha ", 1), ("Khordha", 1), ("Cuttack", 2), (None, 3)],
                               "` District ` string, `Total  Value` long")
    out = CL.basic_clean(df)
    assert out.columns == ["district", "total_value"]
    assert sorted(rows(out), key=repr) == sorted([("Khordha", 1), ("Cuttack", 2), (None, 3)], key=repr)
    # the input frame is untouched
    assert df.columns == [" District ", "Total  Value"] and df.count() == 4


def test_clean_all_keeps_keys(spark):
    t = {"a": spark.createDataFrame([(" x ",)], "`A A` string"), "b": spark.createDataFrame([(1,)], "B long")}
    out = CL.clean_all(t)
    assert set(out) == {"a", "b"} and out["a"].columns == ["a_a"]


def test_drop_rollup_keeps_nulls(spark):
    df = spark.createDataFrame([("Angul",), (" TOTAL ",), (None,), ("Totals",)], "district string")
    assert sorted(rows(CL.drop_rollup(df)), key=repr) == sorted([("Angul",), (None,), ("Totals",)], key=repr)


def test_fill_forward_explicit_order(spark):
    df = spark.createDataFrame([(1, 1, 10.0), (1, 2, None), (1, 3, None), (2, 1, None), (2, 2, 5.0), (1, 4, 7.0)],
                               "k long, t long, v double")
    out = CL.fill_forward(df, ["v"], ["k"], ["t"]).orderBy("k", "t")
    assert [r.v for r in out.collect()] == [10.0, 10.0, 10.0, 7.0, None, 5.0]


def test_fill_zero_numeric_only(spark):
    df = spark.createDataFrame([(None, None, None)], "a long, b double, s string")
    assert rows(CL.fill_zero(df)) == [(0, 0.0, None)]


def test_fill_missing_unknown_strategy_is_identity(spark):
    df = spark.createDataFrame([(None,)], "a long")
    assert CL.fill_missing(df, "median") is df


def test_listwise_drop_nan_and_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (float("nan"), 1.0), (None, 1.0), (3.0, 4.0)], "a double, b double")
    assert rows(CL.listwise_drop(df, ["a", "b"])) == [(1.0, 2.0), (3.0, 4.0)]


def test_lenient_numeric(spark):
    df = spark.createDataFrame([("33.335",), ("n/a",)], "v string")
    # numpy/pandas round by scaling first: 33.335 * 100 == 3333.5 exactly, a tie -> 33.34
    # (Python's round() works on the exact decimal value and would give 33.33)
    assert rows(CL.lenient_numeric(df, "v", "x"), "x") == [(33.34,), (0.0,)]


def test_zfill_code(spark):
    df = spark.createDataFrame([("123",), ("123456789012",)], "awc_code string")
    assert rows(CL.zfill_code(df)) == [("00000000123",), ("123456789012",)]


def test_fill_missing_ffill(spark):
    df = spark.createDataFrame([(1, 1, 5.0), (1, 2, None), (1, 30, None)], "k long, t long, v double")
    out = CL.fill_missing(df, "ffill", columns=["v"], partition_by=["k"], order_by=["t"])
    assert [r.v for r in out.orderBy("t").collect()] == [5.0, 5.0, 5.0]
