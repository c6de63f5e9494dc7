"""End to end on a hand-made month folder shaped like the real exports
(FIXTURES.md traps): repeated and blank headers, quoted headers with commas
and month text, upper-case headers, an integer-looking percent value, a
Total rollup row, zero denominators, a partial-coverage source, the SNP file
dated one month later, and district names with padding, case and en dashes."""

import csv
import os

from gridcube import jobs
from gridcube.sources.registry import SOURCES

MONTH = "2025-11"
NAMES = ["  ANGUL ", "cuttack", "Nabarangpur–west"]    # raw spellings across files
CLEAN = {"Angul", "Cuttack", "Nabarangpur-West"}


def _header(spec):
    if spec.name == "hv":   # month text appended, quoted because of the comma
        return [spec.raw[0]] + [f"{h} 01 -  30 Nov, 2025" for h in spec.raw[1:]]
    return list(spec.raw)


def _rows(spec):
    names = NAMES[:2] if spec.name == "ag" else NAMES          # AG covers two districts only
    rows = []
    for i, name in enumerate(names):
        row = []
        for pos, (_, canon, typ) in enumerate(spec.columns):
            if pos == 0:
                row.append(name if spec.name != "me_status" else f"row{i}")
            elif canon == "category":
                row.append(f"cat{i}")
            elif canon == "hb_measured_child":
                row.append("0")                                  # zero denominator in every row
            elif typ == "double":
                row.append("2" if pos == 3 else f"{10.5 + i}")   # integer-looking value in a percent column
            elif typ == "string":
                row.append(f"{40 + i}.25")
            else:
                row.append(str(100 + 10 * i + pos))
        rows.append(row)
    if spec.name == "gm_0_5":
        rows.append(["Total"] + [r for r in rows[0][1:]])
    return rows


def write_month(base):
    folder = os.path.join(base, MONTH)
    os.makedirs(folder, exist_ok=True)
    for spec in SOURCES.values():
        with open(os.path.join(folder, spec.file_name(MONTH)), "w", newline="") as fh:
            w = csv.writer(fh)
            w.writerow(_header(spec))
            w.writerows(_rows(spec))
    return base


def test_month_folder_end_to_end(spark, tmpdir_path):
    raw = write_month(os.path.join(tmpdir_path, "raw"))
    etl = os.path.join(tmpdir_path, "etl")
    written = jobs.run_month(spark, raw, etl)
    assert set(written) == set(SOURCES)                          # all 13 files found (SNP via next month)
    cube = jobs.run_cube(spark, raw, os.path.join(tmpdir_path, "cube"))
    rows = {r.district: r for r in cube.collect()}
    assert set(rows) == CLEAN                                    # keys cleaned alike in every file; Total dropped
    assert rows["Angul"].child_anaemia_rate == 0.0
    assert rows["Nabarangpur-West"].ag_anaemia_rate is None      # outside AG coverage: NULL, row kept
    assert rows["Angul"].ag_anaemia_rate is not None
    assert rows["Cuttack"].visit_coverage_pct == 41.25           # text percentage parsed leniently
    assert {"total_pw_x", "total_pw_y", "measurement_coverage_pct_x", "measurement_coverage_pct_y"} <= set(cube.columns)
    me_status = spark.read.parquet(written["me_status"]).collect()
    assert len(me_status) == 3 and {r.category for r in me_status} == {"cat0", "cat1", "cat2"}


def test_month_folder_reconciliations(spark, tmpdir_path):
    from pyspark.sql import functions as F

    from gridcube.operators import quality as Q
    raw = write_month(os.path.join(tmpdir_path, "raw"))
    etl = os.path.join(tmpdir_path, "etl")
    written = jobs.run_month(spark, raw, etl)
    month, scanned = jobs.scan_month(spark, raw)
    stored_tables = {n: spark.read.parquet(p).where(F.col("month") == month) for n, p in written.items()}
    rc = Q.rowcount_reconcile(scanned, stored_tables).collect()
    assert len(rc) == 13 and all(r.passed for r in rc)                    # raw <-> warehouse, every file
    stored = jobs.run_cube(spark, raw, os.path.join(tmpdir_path, "cube"))
    fresh = jobs.build_month_cube(jobs.load_cleaned(spark, etl, month))
    diff = Q.tolerance_diff(stored, fresh, ["month", "district"], rtol=1e-6).collect()
    assert diff and all(r.passed for r in diff)                           # stored == fresh within rtol
    assert Q.rebuild_match(stored, stored.select(*stored.columns)).first().passed


def test_folder_scan_tags_rows_with_metadata(spark, tmpdir_path):
    from gridcube.sources import files as FS
    raw = write_month(os.path.join(tmpdir_path, "raw"))
    tables = FS.scan_folder(spark, os.path.join(raw, MONTH), MONTH, ["snp", "hv"])
    assert set(tables) == {"snp", "hv"}
    r = tables["snp"].select("month", "source", "file_path").first()
    assert (r.month, r.source) == (MONTH, "snp") and r.file_path.endswith("SNP_Projections_12_2025.csv")
