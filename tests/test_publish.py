"""Months published whole, bad lines set aside, and the cube kept up to date."""

import os

import pytest
from pyspark.sql import functions as F

from gridcube import incremental, jobs
from gridcube.plans import analogues as A
from gridcube.sources import publish as P
from gridcube.sources import quarantine as Q
from gridcube.sources.registry import SOURCES
from tests.conftest import SF_SMALL

MONTH = "2025-11"
LBW = SOURCES["lbw"]


def put(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8", newline="") as f:
        f.write("\n".join(lines))


def export(folder, lines):
    put(folder, LBW.file_name(MONTH), [",".join(LBW.raw), *lines])


# ------------------------------------------------------------ publication

def test_a_killed_job_leaves_the_old_month(spark, tmpdir_path):
    base, one, two = f"{tmpdir_path}/p", spark.range(3), spark.range(5)
    assert P.published(spark, base, MONTH) == {} and P.manifest(spark, base, MONTH) is None
    P.publish(spark, base, MONTH, {"a": one, "b": one})
    broken = two.select(F.raise_error(F.lit("killed")).cast("long").alias("id"))
    with pytest.raises(Exception, match="killed"):
        P.publish(spark, base, MONTH, {"a": two, "b": broken})                # the first table is written, the second dies
    seen = P.published(spark, base, MONTH)
    assert {n: df.count() for n, df in seen.items()} == {"a": 3, "b": 3}
    P.publish(spark, base, MONTH, {"a": two, "b": two})
    assert {n: df.count() for n, df in P.published(spark, base, MONTH).items()} == {"a": 5, "b": 5}
    assert seen["a"].count() == 3                                             # a reader keeps what it resolved
    assert P.published(spark, base, "2025-12") == {}
    assert P.prune(spark, base, MONTH, keep=1) == 2                           # the first run and the killed one
    assert P.published(spark, base, MONTH)["b"].count() == 5


def test_a_failed_check_and_a_second_publisher(spark, tmpdir_path, monkeypatch):
    base = f"{tmpdir_path}/p"
    P.publish(spark, base, MONTH, {"a": spark.range(2)})

    def check(tables):
        raise ValueError(f"only {tables['a'].count()} rows")
    with pytest.raises(ValueError, match="only 1 rows"):
        P.publish(spark, base, MONTH, {"a": spark.range(1)}, check)
    first = P.manifest(spark, base, MONTH)
    P.publish(spark, base, MONTH, {"a": spark.range(4)})
    monkeypatch.setattr(P, "manifest", lambda *a: first)                      # as a run sees it that began before
    with pytest.raises(RuntimeError, match="number 2"):
        P.publish(spark, base, MONTH, {"a": spark.range(9)})
    monkeypatch.undo()
    assert P.published(spark, base, MONTH)["a"].count() == 4


# ------------------------------------------------------------- quarantine

def test_bad_lines_with_file_line_and_reason(spark, tmpdir_path):
    export(tmpdir_path, ["A,10,1", "B,x1,2", "", "C, 30 ,NA", 'D,"40,4', "E,50", "F,60,6,7", "G,7.5,zz", '"H, i",80,8'])
    rows, bad = Q.scan_lines(spark, os.path.join(tmpdir_path, LBW.file_name(MONTH)), LBW)
    assert sorted(tuple(r)[:3] for r in rows.collect()) == [("A", 10, 1), ("C", 30, None), ("H, i", 80, 8)]
    got = {r.line: r for r in bad.collect()}
    assert sorted(got) == [3, 6, 7, 8, 9]
    assert got[3].reason == "total_children_0_6m: x1 is no bigint" and got[3].text == "B,x1,2" and got[3].source == "lbw"
    assert all("wrong number of fields" in got[i].reason for i in (7, 8)) and "7.5 is no bigint; lbw" in got[9].reason
    assert all(r.file_path.endswith(".csv") for r in got.values())


def test_line_numbers_across_splits_and_part_files(spark, tmpdir_path):
    folder = f"{tmpdir_path}/many.csv"
    for part in range(2):
        put(folder, f"part-{part}.csv", [",".join(LBW.raw), *[f"d{i},{'x' if i % 97 == 0 else i},1" for i in range(3000)]])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        rows, bad = Q.scan_lines(spark, folder, LBW)
        assert rows.count() == 2 * (3000 - 31)
        got = sorted((r.file_path[-10:], r.line, r.text) for r in bad.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == sorted((f"part-{p}.csv", i + 2, f"d{i},x,1") for p in range(2) for i in range(0, 3000, 97))


def test_threshold_header_and_extension(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, LBW.file_name(MONTH))
    export(tmpdir_path, ["A,1,1", "B,x,2", "C,3,3", "D,4,4"])
    Q.scan_lines(spark, path, LBW, max_bad=0.25)
    with pytest.raises(Q.TooManyBadLines, match="1 of 4"):
        Q.scan_lines(spark, path, LBW, max_bad=0.2)
    put(tmpdir_path, "other.csv", ["a,b,c", "1,2,3"])
    with pytest.raises(KeyError):
        Q.scan_lines(spark, f"{tmpdir_path}/other.csv", LBW)
    with pytest.raises(ValueError):
        Q.scan_lines(spark, f"{tmpdir_path}/other.txt", LBW)
    put(tmpdir_path, "none.csv", ["﻿" + ",".join(LBW.raw)])
    assert [df.count() for df in Q.scan_lines(spark, f"{tmpdir_path}/none.csv", LBW, max_bad=0)] == [0, 0]


def test_month_goes_on_and_reports(spark, tmpdir_path):
    raw, base = f"{tmpdir_path}/raw", f"{tmpdir_path}/pub"
    export(f"{raw}/{MONTH}", [f"d{i},{i},1" for i in range(40)] + ["bad,x,1"])
    jobs.publish_month(spark, raw, base)
    tables = P.published(spark, base, MONTH)
    assert tables["lbw"].count() == 40 and [r.line for r in tables["_quarantine"].collect()] == [42]
    row = tables["_report"].where("source = 'lbw'").first()
    assert (row.status, row.rows, row.bad_lines) == ("loaded", 40, 1)
    assert set(jobs.load_published(spark, base, MONTH)) == {"lbw"}
    export(f"{raw}/{MONTH}", ["bad,x,1", "a,1,1"])
    with pytest.raises(Q.TooManyBadLines):
        jobs.publish_month(spark, raw, base)
    assert jobs.load_published(spark, base, MONTH)["lbw"].count() == 40       # the month as it was


# ------------------------------------------------------- incremental cube

ORDER = ["gm_5_6", "lbw", "me"]


def _files(base):
    out = {}
    for folder, _, names in os.walk(f"{base}/cube"):
        out |= {os.path.join(folder, n): os.path.getmtime(os.path.join(folder, n)) for n in names if n.endswith(".parquet")}
    return out


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_delta_runs_equal_a_rebuild_and_leave_the_rest(spark, tmpdir_path):
    base = f"{tmpdir_path}/inc"
    src = {s: A.SOURCE_BUILDERS[s](spark, SF_SMALL, None) for s in ORDER}

    def rebuilt(tables):
        return jobs.build_month_cube({s: df.withColumn("month", F.lit(MONTH)) for s, df in tables.items()}, ORDER, grain=True)

    log = incremental.update(spark, base, MONTH, src, ORDER)
    incremental.update(spark, base, "2025-12", src, ORDER)
    n = rebuilt(src).count()
    assert log.where("change = 'added' and source = 'gm_5_6'").count() == n
    assert _same(incremental.cube(spark, base, MONTH), rebuilt(src))

    before = _files(base)
    some = src["gm_5_6"].join(src["lbw"], "district").agg(F.min("district")).first()[0]
    fixed = dict(src, lbw=src["lbw"].withColumn("lbw_children_0_6m", F.when(F.col("district") == some, 99).otherwise(F.col("lbw_children_0_6m")).cast("long")))
    log = incremental.update(spark, base, MONTH, {"lbw": fixed["lbw"]}, ORDER).collect()
    assert {r.change for r in log} == {"changed"} and len(log) == 1
    assert _same(incremental.cube(spark, base, MONTH), rebuilt(fixed))
    after = _files(base)
    changed = {os.path.dirname(f) for f in set(before) ^ set(after)}
    assert len(changed) == 1 and f"month={MONTH}" in changed.pop()            # one bucket of one month
    assert all(after[f] == t for f, t in before.items() if f in after)

    assert incremental.update(spark, base, MONTH, {"lbw": fixed["lbw"]}, ORDER).count() == 0      # the same export again
    assert _files(base) == after


def test_a_moved_total_reaches_every_share_of_its_month_only(spark, tmpdir_path):
    base = f"{tmpdir_path}/inc"
    cols = SOURCES["me"].canonical
    kinds = SOURCES["me"].schema()

    def me(scale):
        vals = [[f"D{i}", *[(2 * i + 1) * (scale if i == 3 else 1) if c == "aww_completed_80pct_me" else 10 + i for c in cols[1:]]] for i in range(9)]
        return spark.createDataFrame([tuple(float(v) if f.dataType.typeName() == "double" else v for v, f in zip(r, kinds)) for r in vals], kinds)

    gm = spark.createDataFrame([tuple(f"D{i}" if f.name == "district" else (float(i) if f.dataType.typeName() == "double" else i) for f in SOURCES["gm_5_6"].schema())
                                for i in range(10)], SOURCES["gm_5_6"].schema())
    for m in (MONTH, "2025-12"):
        incremental.update(spark, base, m, {"gm_5_6": gm, "me": me(1)}, ["gm_5_6", "me"])
    before = _files(base)
    log = incremental.update(spark, base, MONTH, {"me": me(7)}, ["gm_5_6", "me"])
    assert sorted((r.change, r["count"]) for r in log.groupBy("change").count().collect()) == [("changed", 1), ("share", 8)]
    want = jobs.build_month_cube({s: d.withColumn("month", F.lit(MONTH)) for s, d in (("gm_5_6", gm), ("me", me(7)))}, ["gm_5_6", "me"], grain=True)
    assert _same(incremental.cube(spark, base, MONTH), want)
    assert {f: t for f, t in _files(base).items() if "2025-12" in f} == {f: t for f, t in before.items() if "2025-12" in f}
    # an entity that leaves, and one without a key
    less = gm.where("district <> 'D4'").unionByName(gm.limit(1).withColumn("district", F.lit(None).cast("string")))
    log = incremental.update(spark, base, MONTH, {"gm_5_6": less}, ["gm_5_6", "me"])
    assert sorted((r.district, r.change) for r in log.where("district is not null").collect()) == [("D4", "removed")] and log.count() == 2
    want = jobs.build_month_cube({s: d.withColumn("month", F.lit(MONTH)) for s, d in (("gm_5_6", less), ("me", me(7)))}, ["gm_5_6", "me"], grain=True)
    assert _same(incremental.cube(spark, base, MONTH), want)
