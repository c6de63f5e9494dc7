import itertools
import math
import random

import pandas as pd
import pytest

from gridcube.operators import stats as ST


def test_top_n_ties_and_nulls(spark):
    df = spark.createDataFrame([(3, 5.0), (1, 5.0), (2, None), (4, 1.0)], "k long, v double")
    top = [(r.k, r.rank) for r in ST.top_n(df, "v", 3, ["k"]).collect()]
    assert sorted(top, key=lambda t: t[1]) == [(1, 1), (3, 2), (4, 3)]
    allrows = [r.k for r in ST.top_n(df, "v", 10, ["k"]).orderBy("rank").collect()]
    assert allrows == [1, 3, 4, 2]   # nulls last when n exceeds the non-null rows
    assert [r.k for r in ST.bottom_n(df, "v", 2, ["k"]).orderBy("rank").collect()] == [4, 1]


def _frame(spark, n=60, seed=7, with_nulls=True):
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        a = rnd.randint(0, 6)
        b = a + rnd.choice([-1, 0, 1, 2])
        c = None if (with_nulls and i % 7 == 0) else rnd.random()
        data.append((float(a), float(b), c))
    return spark.createDataFrame(data, "a double, b double, c double"), pd.DataFrame(data, columns=list("abc"))


def test_listwise_and_pairwise_match_pandas(spark):
    df, pdf = _frame(spark)
    lw = {(r.indicator_a, r.indicator_b): r for r in ST.corr_pairs_listwise(df, ["a", "b", "c"], None).collect()}
    exp = pdf.dropna().corr()
    assert math.isclose(lw[("a", "b")].correlation, exp.loc["a", "b"], rel_tol=1e-9)
    assert lw[("a", "b")].n_rows == len(pdf.dropna())
    pw = {(r.indicator_a, r.indicator_b): r.correlation for r in ST.corr_matrix_pairwise(df, ["a", "b", "c"], None).collect()}
    expp = pdf.corr()
    for x, y in itertools.product("abc", repeat=2):
        assert math.isclose(pw[(x, y)], expp.loc[x, y], rel_tol=1e-9, abs_tol=1e-12)


def test_listwise_missing_column_raises(spark):
    df, _ = _frame(spark)
    with pytest.raises(KeyError):
        ST.corr_pairs_listwise(df, ["a", "zz"])
    with pytest.raises(ValueError):
        ST.corr_matrix_pairwise(df, ["a", "zz"])


def test_strongest_direction(spark):
    df, pdf = _frame(spark)
    s = ST.corr_strongest(ST.corr_pairs_listwise(df, ["a", "b", "c"]), 2).orderBy("rank").collect()
    assert len(s) == 2 and abs(s[0].correlation) >= abs(s[1].correlation)
    assert s[0].direction == ("positive" if s[0].correlation > 0 else "negative")


def test_spearman_matches_pandas_pairwise(spark):
    df, pdf = _frame(spark)
    got = {(r.indicator_a, r.indicator_b): r.correlation for r in ST.corr_spearman(df, ["a", "b", "c"], None).collect()}
    exp = pdf.corr(method="spearman")
    for (x, y), v in got.items():
        assert math.isclose(v, exp.loc[x, y], rel_tol=1e-9)


def test_kendall_against_brute_force(spark):
    df, pdf = _frame(spark, n=80)
    for x, y in [("a", "b"), ("a", "c"), ("b", "c")]:
        sub = pdf[[x, y]].dropna()
        xs, ys = list(sub[x]), list(sub[y])
        s = sum(((xi > xj) - (xi < xj)) * ((yi > yj) - (yi < yj))
                for (xi, yi), (xj, yj) in itertools.combinations(zip(xs, ys), 2))
        n0 = len(xs) * (len(xs) - 1) / 2
        n1 = sum(c * (c - 1) / 2 for c in sub[x].value_counts())
        n2 = sum(c * (c - 1) / 2 for c in sub[y].value_counts())
        exp = s / math.sqrt((n0 - n1) * (n0 - n2))
        got = ST.kendall_pair(df, x, y).first()
        assert got.n_rows == len(xs)
        assert math.isclose(got.correlation, exp, rel_tol=1e-12)


def test_kendall_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0), (1.0, 3.0)], "a double, b double")
    assert ST.kendall_pair(df, "a", "b").first().correlation is None


def test_average_rank_with_ties_across_buckets(spark):
    vals = [1.0] * 50 + [2.0] * 3 + list(range(3, 200))
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    got = {r.value: r.avg_rank for r in ST.average_rank(df, "v").collect()}
    exp = pd.Series(vals).rank(method="average")
    for v, r in zip(vals, exp):
        assert got[float(v)] == r


def test_square_matrix_and_single_pair_spearman(spark):
    df, pdf = _frame(spark)
    long = ST.corr_matrix_pairwise(df, ["a", "b", "c"], None)
    sq = ST.to_square(long, ["a", "b", "c"]).collect()
    assert [r.indicator_a for r in sq] == ["a", "b", "c"]
    exp = pdf.corr()
    assert math.isclose(sq[0]["b"], exp.loc["a", "b"], rel_tol=1e-9) and math.isclose(sq[2]["c"], 1.0)
    one = ST.spearman_pair(df, "a", "b").first()
    assert math.isclose(one.correlation, pdf.corr(method="spearman").loc["a", "b"], rel_tol=1e-9)


def test_listwise_with_no_surviving_rows_reports_every_pair(spark):
    df = spark.createDataFrame([(1.0, None, 2.0), (None, 3.0, 4.0)], "a double, b double, c double")
    out = ST.corr_pairs_listwise(df, ["a", "b", "c"]).collect()
    assert len(out) == 3 and all(r.correlation is None and r.n_rows == 0 for r in out)
    top = ST.corr_strongest(ST.corr_pairs_listwise(df, ["a", "b", "c"]), 10).collect()
    assert len(top) == 3 and {r.direction for r in top} == {"negative"}


def test_listwise_per_group_matches_pandas(spark):
    rnd = random.Random(11)
    data = [(g, float(rnd.randint(0, 9)), float(rnd.randint(0, 9)), None if rnd.random() < 0.2 else rnd.random())
            for g in ("m1", "m2", "m3") for _ in range(20)]
    df = spark.createDataFrame(data, "month string, a double, b double, c double")
    pdf = pd.DataFrame(data, columns=["month", "a", "b", "c"])
    got = {(r.month, r.indicator_a, r.indicator_b): r for r in
           ST.corr_pairs_listwise(df, ["a", "b", "c"], None, by=["month"]).collect()}
    assert len(got) == 9
    for m, part in pdf.groupby("month"):
        sub = part[["a", "b", "c"]].dropna()
        exp = sub.corr()
        assert got[(m, "a", "c")].n_rows == len(sub)
        assert math.isclose(got[(m, "b", "c")].correlation, exp.loc["b", "c"], rel_tol=1e-9)


def test_top_bottom_per_group(spark):
    data = [(g, f"d{i}", float((i * 7 + ord(g[-1])) % 11)) for g in ("m1", "m2") for i in range(8)]
    df = spark.createDataFrame(data, "month string, District string, v double")
    rep = ST.top_bottom_report(df, "District", ["v", "absent"], 3, by=["month"]).collect()
    assert len(rep) == 2 * 2 * 3
    pdf = pd.DataFrame(data, columns=["month", "District", "v"])
    for g, part in pdf.groupby("month"):
        exp = part.sort_values(["v", "District"], ascending=[False, True]).head(3)["District"].tolist()
        got = [r.District for r in sorted(rep, key=lambda r: r.rank) if r.month == g and r.side == "top"]
        assert got == exp
