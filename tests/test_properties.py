"""Property tests: the Spark expressions agree with the Python/numpy
behaviour they reproduce, on generated inputs (one Spark job per batch)."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gridcube.functions import exprs as X

TEXT = st.text(alphabet=st.sampled_from(list("abcXYZ éÉöÖ'-_.,/0123456789\t")), max_size=24)


@settings(max_examples=25, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=40))
def test_py_title_matches_str_title(spark, words):
    df = spark.createDataFrame([(w,) for w in words], "s string")
    got = [r[0] for r in df.select(X.py_title("s")).collect()]
    assert got == [w.title() for w in words]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.floats(min_value=-1e6, max_value=1e6, allow_nan=False), min_size=1, max_size=40),
       st.integers(min_value=0, max_value=4))
def test_rnd_matches_numpy(spark, xs, n):
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    got = [r[0] for r in df.select(X.rnd("x", n)).collect()]
    assert got == [float(np.round(x, n)) for x in xs]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("+-0123456789ab")), max_size=14), min_size=1, max_size=40))
def test_zfill_matches_python(spark, vals):
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r[0] for r in df.select(X.zfill("s", 11)).collect()]
    assert got == [v.zfill(11) for v in vals]


VALS = st.one_of(st.none(), st.integers(min_value=-3, max_value=3).map(float))


def _kendall_brute(pairs):
    pts = [(x, y) for x, y in pairs if x is not None and y is not None]
    n = len(pts)
    if n < 2:
        return None, n
    s = n1 = n2 = 0
    for i in range(n):
        for j in range(i + 1, n):
            dx, dy = pts[i][0] - pts[j][0], pts[i][1] - pts[j][1]
            s += ((dx > 0) - (dx < 0)) * ((dy > 0) - (dy < 0))
            n1 += dx == 0
            n2 += dy == 0
    n0 = n * (n - 1) / 2
    den = (n0 - n1) * (n0 - n2)
    return (s / den ** 0.5 if den > 0 else None), n


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(VALS, VALS), min_size=0, max_size=30))
def test_kendall_matches_brute_force(spark, rows):
    from gridcube.operators import stats as ST
    df = spark.createDataFrame(rows or [(None, None)], "x double, y double")
    got = ST.kendall_pair(df, "x", "y").first()
    exp, n = _kendall_brute(rows)
    assert got.n_rows == n
    if exp is None:
        assert got.correlation is None
    else:
        assert abs(got.correlation - exp) < 1e-12


@pytest.mark.filterwarnings("ignore:invalid value encountered:RuntimeWarning")   # pandas on constant columns
@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(VALS, VALS), min_size=0, max_size=30))
def test_spearman_matches_pandas(spark, rows):
    import math

    import pandas as pd
    from gridcube.operators import stats as ST
    df = spark.createDataFrame(rows or [(None, None)], "x double, y double")
    got = ST.spearman_pair(df, "x", "y").first()
    pdf = pd.DataFrame(rows, columns=["x", "y"], dtype=float).dropna()
    assert got.n_rows == len(pdf)
    exp = pdf["x"].rank().corr(pdf["y"].rank()) if len(pdf) > 1 else float("nan")
    if exp is None or math.isnan(exp):
        assert got.correlation is None
    else:
        assert abs(got.correlation - exp) < 1e-9
