import math

import pytest

from gridcube.functions import exprs as X


def one(spark, expr, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr).collect()]


def test_round_half_even_ties(spark):
    import numpy as np
    xs = [0.125, 0.375, 0.285, 2.675, 33.335, -0.125, 1e-9, 12345.675]
    got = one(spark, X.rnd("x", 2), [(x,) for x in xs] + [(None,)], "x double")
    assert got == [float(np.round(x, 2)) for x in xs] + [None]
    assert got[:2] == [0.12, 0.38]      # exact binary ties go to even; Spark's round() gives 0.13
    for n in (0, 1, 3, 6):
        got = one(spark, X.rnd("x", n), [(x,) for x in xs], "x double")
        assert got == [float(np.round(x, n)) for x in xs]


def test_round_half_even_integers(spark):
    assert one(spark, X.rnd("x", 0), [(0.5,), (1.5,), (2.5,), (-0.5,)], "x double") == [0.0, 2.0, 2.0, -0.0]


def test_safe_ratio_zero_and_missing(spark):
    data = [(1, 4), (1, 0), (0, 0), (None, 3), (3, None)]
    assert one(spark, X.safe_ratio("a", "b"), data, "a long, b long") == [0.25, 0.0, 0.0, 0.0, 0.0]


def test_safe_ratio_three_places(spark):
    assert one(spark, X.safe_ratio("a", "b", 3), [(1, 8), (2, 3)], "a long, b long") == [0.125, 0.667]


def test_ratio_inf_to_zero(spark):
    data = [(5.0, 0.0), (-5.0, 0.0), (0.0, 0.0), (1.0, 3.0), (None, 2.0)]
    got = one(spark, X.ratio_inf_to_zero("a", "b"), data, "a double, b double")
    assert got == [0.0, 0.0, None, 0.33, None]


def test_pct_keeps_null_on_zero(spark):
    assert one(spark, X.pct("a", "b"), [(1, 3), (1, 0)], "a long, b long") == [33.33, None]


def test_py_title_matches_python(spark):
    words = ["o'brien-smith", "  NATION_0 ", "1st ave", "école du–x", "mc donald's", "", "ABC def"]
    got = one(spark, X.py_title("s"), [(w,) for w in words], "s string")
    assert got == [w.title() for w in words]


def test_clean_key(spark):
    data = [("  KHORDHA ",), ("cuttack",), ("angul–deogarh",), ("new  delhi",), (None,)]
    got = one(spark, X.clean_key("s"), data, "s string")
    assert got == ["Khordha", "Cuttack", "Angul-Deogarh", "New Delhi", None]


@pytest.mark.parametrize("v", ["123", "45678", "12345678901", "123456789012", "-42", "+7", ""])
def test_zfill_matches_python(spark, v):
    assert one(spark, X.zfill("s", 11), [(v,)], "s string") == [v.zfill(11)]


def test_lenient_num(spark):
    got = one(spark, X.lenient_num("s"), [("12.5",), ("abc",), (None,), (" 7 ",), ("1e2",)], "s string")
    assert got == [12.5, 0.0, 0.0, 7.0, 100.0]


def test_weighted_score_uses_rounded_inputs(spark):
    got = one(spark, X.weighted_score("a", "b"), [(0.57, 0.43)], "a double, b double")
    assert got == [round(0.57 * 0.8 + (1 - 0.43) * 0.2, 3)]


def test_safe_corr_null_on_constant_and_pairwise(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, None, 5.0), (4.0, 8.5, 5.0)],
                               "a double, b double, c double")
    r = df.agg(X.safe_corr("a", "b").alias("ab"), X.safe_corr("a", "c").alias("ac")).first()
    import pandas as pd
    pdf = pd.DataFrame({"a": [1, 2, 3, 4], "b": [2, 4, None, 8.5]})
    assert math.isclose(r.ab, pdf.corr().loc["a", "b"], rel_tol=1e-12)
    assert r.ac is None


def test_strip_is_linear_and_as_python(spark):
    import time

    from pyspark.sql import functions as F

    from gridcube.functions import exprs as X
    space = ["\t", "\n", "\x0b", "\x0c", "\r", "\x1c", "\x1f", " ", "\x85", " ", " ", " ", "　"]
    texts = ["".join(space) + "a" + "".join(space) + "b" + "".join(space), "".join(space), "", "x\n", "\nx", " \r\n"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    assert [r[0] for r in df.select(X.strip("s")).collect()] == [t.strip() for t in texts]
    long = spark.range(1).select(F.concat(F.lit("a"), F.repeat(F.lit(" "), 1_000_000), F.lit("b")).alias("s"))
    start = time.perf_counter()
    assert long.select(F.length(X.strip("s")).alias("n")).first().n == 1_000_002
    assert time.perf_counter() - start < 5
