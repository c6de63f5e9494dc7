import os

import pytest
from pyspark.sql import functions as F

from gridcube import jobs
from gridcube.functions import exprs as X
from gridcube.operators import clean as CL
from gridcube.operators import ml as ML
from gridcube.operators import quality as Q
from gridcube.operators import serve as SV
from gridcube.operators import stats as ST
from gridcube.sources import files as FS
from gridcube.sources.registry import SOURCES


def write(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")


def test_strip_equals_python(spark):
    texts = ["\tAngul\n", " Angul ", " a b ", "\x1cx\x85", "", " \t", "　é　", None, "​z"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.s for r in df.select("i", X.strip("t").alias("s")).collect()}
    assert got == {i: t.strip() if t is not None else None for i, t in enumerate(texts)}
    assert CL.drop_rollup(spark.createDataFrame([("Total\t",), ("x",)], "district string")).count() == 1


def test_lenient_numbers_are_decimal_only(spark):
    df = spark.createDataFrame([(t,) for t in ["NaN", "Infinity", "-inf", "1d", "2f", "1e400", " 1.5 ", "1e2", ".5", "5.", "+7", "0x1", "", None]], "t string")
    assert [r.v for r in CL.lenient_numeric(df, "t", "v").collect()] == [0, 0, 0, 0, 0, 0, 1.5, 100, 0.5, 5, 7, 0, 0, 0]


def test_ratio_and_ranks_ignore_nan(spark):
    nan = float("nan")
    df = spark.createDataFrame([("a", nan, 2.0), ("b", 1.0, nan), ("c", 4.0, 2.0)], "k string, x double, y double")
    assert [r.q for r in df.select(X.safe_ratio("x", "y").alias("q")).collect()] == [0.0, 0.0, 2.0]
    assert [r.k for r in ST.top_n(df, "x", 3, ["k"]).orderBy("rank").collect()] == ["c", "b", "a"]
    assert ST.corr_matrix_pairwise(df, ["x", "y"]).where("pos_a = 0 and pos_b = 1").first().n_rows == 1
    assert ST.top_bottom_report(df, "k", ["nothing"]).count() == 0 and SV.scatter_points(df, [("p", "q")], "k").count() == 0


def test_metrics_use_jointly_present_rows(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (3.0, 2.0), (9.0, None), (None, 4.0)], "y double, p double")
    r = ML.regression_metrics(df, "y", "p").first()
    assert r.n == 3 and r.r2 == pytest.approx(1 - 1.25 / 2) and r.mae == 0.5
    assert ML.train_frame(df, ["p"], "y", min_rows=3).count() == 3
    with pytest.raises(ValueError):
        ML.train_frame(df, ["p"], "y", min_rows=4)
    split = spark.createDataFrame([(None,), ("a",)], "k string").withColumn("t", ML.holdout_flag("k"))
    assert split.where("t").count() + split.where("not t").count() == 2


def test_report_and_unknown_files(spark, tmpdir_path):
    folder = os.path.join(tmpdir_path, "2025-11")
    write(os.path.join(folder, "Low_Birth_Weight_11_2025.csv"), ["District,Total Children 0-6M,Low Birth Weight Children 0-6M,It's New", "angul,NA,1,x"])
    write(os.path.join(folder, "AWC_11_2025.csv"), ["District,Wrong", "a,1"])
    write(os.path.join(folder, "New_Source_11_2025.csv"), ["District,Some Value", "a,7"])
    report = {r.source: r for r in FS.folder_report(spark, folder, "2025-11").collect()}
    assert (report["lbw"].status, report["lbw"].extra_columns) == ("loaded", 1)
    assert report["awc"].status == "mismatch" and report["hv"].status == "missing" and report["New_Source_11_2025"].status == "unknown"
    tables = FS.scan_folder(spark, folder, "2025-11", names=["lbw"])
    r = tables["lbw"].first()
    assert r.total_children_0_6m is None and r.lbw_children_0_6m == 1 and r.file_path.endswith(".csv")
    assert FS.profile_table(tables["lbw"], "lbw").where(F.col("column").contains("'")).count() == 1
    os.remove(os.path.join(folder, "AWC_11_2025.csv"))
    out = jobs.run_month(spark, tmpdir_path, os.path.join(tmpdir_path, "etl"))
    assert set(out) == {"lbw", "New_Source_11_2025"}
    stored = spark.read.parquet(out["New_Source_11_2025"]).first()
    assert stored.some_value == "7" and stored.source == "New_Source_11_2025" and stored.file_path.endswith("New_Source_11_2025.csv")
    loaded = jobs.load_cleaned(spark, os.path.join(tmpdir_path, "etl"), "2025-11")["lbw"]
    assert "file_path" not in loaded.columns and loaded.count() == 1
    assert spark.read.parquet(os.path.join(tmpdir_path, "etl", "_report")).count() == len(SOURCES) + 1


def test_every_part_of_a_csv_folder_is_checked(spark, tmpdir_path):
    folder = os.path.join(tmpdir_path, "Low_Birth_Weight_11_2025.csv")
    head = "District,Total Children 0-6M,Low Birth Weight Children 0-6M"
    write(os.path.join(folder, "part-0.csv"), [head, "a,1,0"])
    write(os.path.join(folder, "part-1.csv"), ["District,Low Birth Weight Children 0-6M,Total Children 0-6M", "b,0,1"])
    with pytest.raises(Exception, match="(?i)header"):
        FS.scan_csv(spark, folder, SOURCES["lbw"]).collect()


def test_centre_rows_are_summed_to_the_entity(spark):
    hv = spark.createDataFrame([("a", 1, 10, 5, "50", 1), (" A\t", 2, 30, 5, "16.7", 1), ("b", 1, 4, 1, "24.9", 0)],
                               "district string, total_aww long, target_visits long, visits_made long, visit_coverage_pct string, aww_60pct_hv long")
    rows = {r.district: r for r in jobs.entity_rows(hv, "hv", ["month", "district"]).collect()}
    assert rows["A"].visits_made == 10 and rows["A"].visit_coverage_pct == "25.0" and rows["B"].visit_coverage_pct == "24.9"


def test_static_sources_keep_one_row_a_month(spark):
    lbw = spark.createDataFrame([("a", 10, 1, "2025-10"), ("a", 20, 1, "2025-11")],
                                "district string, total_children_0_6m long, lbw_children_0_6m long, month string")
    awc = spark.createDataFrame([("a", 4, 3, 1, 0, 0)], "district string, total_awc long, active_awc long, inactive_awc long, new_awc_month long, inactive_awc_month long")
    cube = jobs.build_month_cube({"lbw": lbw, "awc": awc}, ["lbw", "awc"], strict=True)
    assert cube.count() == 2 and cube.where("active_awc = 3").count() == 2


def test_tolerance_compares_text_too(spark):
    a = spark.createDataFrame([(1, "a", 1.0), (2, "x", 2.0)], "k int, t string, v double")
    b = spark.createDataFrame([(1, "b", 1.0), (2, "x", 2.0 + 1e-9)], "k int, t string, v double")
    got = {r.column: r.mismatches for r in Q.tolerance_diff(a, b, ["k"]).collect()}
    assert got == {"t": 1, "v": 0}


def test_lookup_records_and_available_list(spark):
    cube = spark.createDataFrame([("Angul", 1.0), ("Nuapada", float("nan"))], "District string, `Stunting_Total_%` double")
    req = spark.createDataFrame([(1, " angul\n"), (2, "apa"), (3, "zzz"), (4, ""), (5, None)], "id long, name string")
    rows = SV.lookup_records(req, "id", "name", cube).collect()
    by = {r.request_id: r for r in rows if r.request_id is not None}
    assert by[1].status == "exact" and by[1].stunting_5_6.stunting_pct == 1.0 and '"District":"Angul"' in by[1].raw
    assert by[2].match == "Nuapada" and by[2].stunting_5_6.stunting_pct is None and by[4].match == "Angul"
    assert by[3].status == by[5].status == "not_found" and sorted(r.match for r in rows if r.status == "available") == ["Angul", "Nuapada"]
    assert SV.lookup_records(req.where("id = 1"), "id", "name", cube).count() == 1


def test_rank_matrix_is_full_and_rounded(spark):
    df = spark.createDataFrame([(1.0, 5.0, 1.0), (2.0, 4.0, 1.0), (3.0, 4.5, 1.0)], "a double, b double, c double")
    for method, r in (("spearman", -0.5), ("kendall", -0.33)):
        got = {(x.indicator_a, x.indicator_b): x.correlation for x in ST.rank_matrix(df, ["a", "b", "c"], method).collect()}
        assert len(got) == 9 and got["a", "b"] == got["b", "a"] == r and got["a", "a"] == 1 and got["c", "c"] is None


def test_ranks_and_kendall_over_many_blocks(spark):
    import numpy as np
    rng = np.random.default_rng(4)
    n = 1500
    x = np.where(rng.random(n) < 0.4, 7.0, rng.integers(0, 400, n))          # one value holds two fifths of the rows
    y = np.where(rng.random(n) < 0.3, x, rng.integers(0, 60, n)).astype(float)
    df = spark.createDataFrame(list(zip(x.tolist(), y.tolist())), "a double, b double")
    dx, dy = np.sign(x[:, None] - x[None]), np.sign(y[:, None] - y[None])
    want = (dx * dy).sum() / np.sqrt((dx != 0).sum() * (dy != 0).sum())
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        assert ST.corr_kendall(df, ["a", "b"], None).first().correlation == pytest.approx(want)
        ranks = {r.value: r.avg_rank for r in ST.average_rank(df, "a").collect()}
        order = np.sort(x)
        assert all(r == (np.searchsorted(order, v, "left") + np.searchsorted(order, v, "right") + 1) / 2 for v, r in ranks.items())
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
