import os

import pytest
from pyspark.sql import functions as F

from gridcube.sources import files as FS
from gridcube.sources.registry import SOURCES


def _write_text(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")


ANAEMIA_HEADER = ('District,Total Pregnant Women,Haemoglobin Measured of PW,Anaemic,Total Lactating Mothers,'
                  'Haemoglobin Measured of LM,Anaemic,Total Children (6months - 5 years),'
                  'Haemoglobin Measured of Children (6months - 5 years),Anaemic')


def test_scan_repeated_headers_by_position(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "2025-11", "Anaemia_11_2025.csv")
    _write_text(p, [ANAEMIA_HEADER, "Angul,10,8,2,5,4,1,7,0,0", " khordha ,3,3,3,2,2,0,1,0,0"])
    df = FS.scan_csv(spark, p, SOURCES["anaemia"])
    assert df.columns == SOURCES["anaemia"].canonical
    r = df.where(F.col("district") == "Angul").first()
    assert (r.anaemic_pw, r.anaemic_lm, r.anaemic_child) == (2, 1, 0)
    assert FS.header_names(spark, p)[3::3] == ["Anaemic", "Anaemic.1", "Anaemic.2"]


def test_scan_rejects_bad_header_and_extension(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "Low_Birth_Weight_11_2025.csv")
    _write_text(p, ["District,Total Children,LBW", "a,1,0"])
    with pytest.raises(KeyError):
        FS.scan_csv(spark, p, SOURCES["lbw"])
    with pytest.raises(ValueError):
        FS.scan_csv(spark, os.path.join(tmpdir_path, "x.parquet"), SOURCES["lbw"])
    contract = {r.expected: r.present for r in FS.schema_contract(spark, p, SOURCES["lbw"]).collect()}
    assert contract == {"District": True, "Total Children 0-6M": False, "Low Birth Weight Children 0-6M": False}


def test_quoted_header_with_month_text(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "Home_Visit_11_2025.csv")
    _write_text(p, ['District,"Total AWW Between 01 -  30 Nov, 2025","Total targeted visits Between 01 - 30 Nov, 2025",'
                    '"Total visits made Between 01 - 30 Nov, 2025","% of visits made Between 01 - 30 Nov, 2025",'
                    '"AWW completed 60% HV Between 01 - 30 Nov, 2025"', "Angul,10,100,80,80.0,6"])
    df = FS.scan_csv(spark, p, SOURCES["hv"])
    assert df.first().visit_coverage_pct == "80.0"


def test_month_folders_and_resolution(spark, tmpdir_path):
    for m in ["2025-09", "2025-11", "2025-10", "notes", "2025-1"]:
        os.makedirs(os.path.join(tmpdir_path, m), exist_ok=True)
    assert FS.month_folders(spark, tmpdir_path) == ["2025-09", "2025-10", "2025-11"]
    assert FS.latest_month_folder(spark, tmpdir_path) == "2025-11"
    _write_text(os.path.join(tmpdir_path, "2025-11", "snp_projections_12_2025.CSV"), ["x"])
    got = FS.resolve_files(spark, os.path.join(tmpdir_path, "2025-11"), "2025-11", ["snp", "awc"])
    assert got["awc"] is None and got["snp"].endswith("snp_projections_12_2025.CSV")
    with pytest.raises(RuntimeError):
        FS.latest_month_folder(spark, os.path.join(tmpdir_path, "notes"))
    with pytest.raises(FileNotFoundError):
        FS.month_folders(spark, os.path.join(tmpdir_path, "missing"))


def test_december_rolls_year():
    assert SOURCES["snp"].file_name("2025-12") == "SNP_Projections_01_2026.csv"


def test_profile_and_months(spark):
    df = spark.createDataFrame([("2025-11", None), ("2025-12", 1), ("bad", 2)], "month string, v long")
    prof = {r.column: r for r in FS.profile_table(df, "t").collect()}
    assert prof["v"].missing == 1 and prof["v"].rows == 3
    assert sorted((r.month, r.rows) for r in FS.months_of(df).collect()) == [("2025-11", 1), ("2025-12", 1)]
    assert [r.v for r in FS.latest_month_slice(df).collect()] == [1]
    assert [r.p for r in df.select(FS.projection_month("month").alias("p")).collect()] == ["2025-12", "2026-01", None]


def test_partitioned_sink_dynamic_overwrite(spark, tmpdir_path):
    out = os.path.join(tmpdir_path, "cube")
    a = spark.createDataFrame([("2025-10", "a", 1), ("2025-11", "a", 2)], "month string, k string, v long")
    FS.write_table(a, out)
    FS.write_table(spark.createDataFrame([("2025-11", "a", 3)], "month string, k string, v long"), out)
    got = sorted((r.month, r.v) for r in spark.read.parquet(out).collect())
    assert got == [("2025-10", 1), ("2025-11", 3)]


def test_table_preview(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    assert [r.k for r in FS.table_preview(df, ["k"]).collect()] == [0, 1, 2, 3, 4]


def test_month_overwrite_is_dynamic_even_if_the_session_is_static(spark, tmpdir_path):
    out = os.path.join(tmpdir_path, "t")
    old = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    try:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
        a = spark.createDataFrame([("2025-10", 1), ("2025-11", 2)], "month string, v long")
        FS.write_table(a, out, ["month"], one_file_per_partition=True)
        FS.write_table(spark.createDataFrame([("2025-11", 3)], "month string, v long"), out, ["month"])
        assert sorted((r.month, r.v) for r in spark.read.parquet(out).collect()) == [("2025-10", 1), ("2025-11", 3)]
        assert len([f for f in os.listdir(os.path.join(out, "month=2025-10")) if f.endswith(".parquet")]) == 1
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", old)


def test_scan_tolerates_extra_trailing_columns(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "Low_Birth_Weight_11_2025.csv")
    _write_text(p, ["District,Total Children 0-6M,Low Birth Weight Children 0-6M,New Column", "angul,10,1,x"])
    df = FS.scan_csv(spark, p, SOURCES["lbw"])
    assert df.columns == [*SOURCES["lbw"].canonical, "new_column"] and df.first().lbw_children_0_6m == 1 and df.first().new_column == "x"
    assert FS.scan_csv(spark, p, SOURCES["lbw"], keep_extra=False).columns == SOURCES["lbw"].canonical


def test_scan_handles_bom_and_crlf(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "Low_Birth_Weight_11_2025.csv")
    with open(p, "wb") as fh:
        fh.write(b"\xef\xbb\xbfDistrict,Total Children 0-6M,Low Birth Weight Children 0-6M\r\nangul,10,1\r\ncuttack,20,3\r\n")
    rows = FS.scan_csv(spark, p, SOURCES["lbw"]).orderBy("district").collect()
    assert [(r.district, r.lbw_children_0_6m) for r in rows] == [("angul", 1), ("cuttack", 3)]
