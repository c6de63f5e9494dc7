import os

import pytest

from gridcube import jobs
from gridcube.plans.q_ingest import EXPORT_FULL, EXPORT_MONTH, export_month
from tests.conftest import SF_SMALL


def test_run_cube_from_exports_and_rerun(spark, tmpdir_path):
    raw = export_month(spark, SF_SMALL, EXPORT_FULL)
    out = os.path.join(tmpdir_path, "cube")
    cube = jobs.run_cube(spark, raw, out)
    assert cube.columns[:2] == ["month", "district"]
    n = cube.count()
    assert n > 0
    # a rerun of the same month replaces it (dynamic overwrite), it does not append
    jobs.run_cube(spark, raw, out)
    assert spark.read.parquet(out).count() == n
    # the ETL path gives the same cube
    etl = os.path.join(tmpdir_path, "etl")
    jobs.run_month(spark, raw, etl)
    via_etl = jobs.build_month_cube(jobs.load_cleaned(spark, etl, EXPORT_MONTH))   # same default order as run_cube
    stored = spark.read.parquet(out).select(*via_etl.columns)
    assert stored.exceptAll(via_etl).count() == 0 and via_etl.exceptAll(stored).count() == 0


def test_missing_base_source_fails(spark, tmpdir_path):
    raw = export_month(spark, SF_SMALL, ["lbw", "awc"])
    with pytest.raises(FileNotFoundError):
        jobs.run_cube(spark, raw)
    month, tables = jobs.scan_month(spark, raw)
    assert month == EXPORT_MONTH and set(tables) == {"lbw", "awc"}


def test_missing_side_source_joins_as_nulls(spark):
    base = spark.createDataFrame([("a", 10, 1, "2025-11")],
                                 "district string, total_children_0_6m long, lbw_children_0_6m long, month string")
    cube = jobs.build_month_cube({"lbw": base}, ["lbw", "awc", "ag"])
    assert {"active_awc_pct", "awc_readiness_score", "ag_anaemia_rate"} <= set(cube.columns)
    r = cube.first()
    assert r.lbw_rate_pct == 0.1 and r.active_awc_pct is None and r.ag_anaemia_rate is None


def test_strict_cube_rejects_duplicated_keys(spark):
    base = spark.createDataFrame([("a", 10, 1)], "district string, total_children_0_6m long, lbw_children_0_6m long")
    awc = spark.createDataFrame([("a", 4, 3, 1, 0, 0), ("A ", 4, 3, 1, 0, 0)],
                                "district string, total_awc long, active_awc long, inactive_awc long, "
                                "new_awc_month long, inactive_awc_month long")
    tables = {"lbw": base, "awc": awc}
    assert jobs.build_month_cube(tables, ["lbw", "awc"]).count() == 2          # fan-out when not strict
    with pytest.raises(ValueError, match="awc"):
        jobs.build_month_cube(tables, ["lbw", "awc"], strict=True)
