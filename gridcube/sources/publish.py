"""Tables of a month published together: all of them or none.

A run writes its tables into a folder of its own, which no reader looks at. Only
when all are written does it publish them by renaming one small manifest into
place, numbered after the last one; readers resolve the newest manifest. A job
that dies between two tables leaves the former month as it was, and a month is
never seen half old, half new.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from gridcube.sources.files import _listdir, path_exists


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _manifests(spark: SparkSession, base: str, month: str) -> list[str]:
    folder = f"{base}/_manifests/{month}"
    return sorted(n for n in _listdir(spark, folder) if n.endswith(".json")) if path_exists(spark, folder) else []


def manifest(spark: SparkSession, base: str, month: str) -> dict | None:
    """The newest manifest of a month: number, run and table -> path; None before the first."""
    names = _manifests(spark, base, month)
    if not names:
        return None
    text = "\n".join(r.value for r in spark.read.text(f"{base}/_manifests/{month}/{names[-1]}").collect())   # a line a table
    return json.loads(text)


def publish(spark: SparkSession, base: str, month: str, tables: dict[str, DataFrame], check=None) -> dict:
    """Write the month's tables under a new run and publish them with one rename.
    ``check`` (table name -> what was written, as a DataFrame) runs before that and
    stops the publication by raising. Of two runs at once the one that renames
    second fails. Returns the manifest."""
    run, last = uuid.uuid4().hex[:12], manifest(spark, base, month)
    paths = {}
    for name, df in tables.items():
        paths[name] = f"_runs/{month}/{run}/{name}"
        df.write.parquet(f"{base}/{paths[name]}")
    if check is not None:
        check({n: spark.read.parquet(f"{base}/{p}") for n, p in paths.items()})
    entry = {"number": 1 + (last["number"] if last else 0), "run": run, "tables": paths}
    folder = f"{base}/_manifests/{month}"
    fs, _ = _fs(spark, folder)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    draft, final = path(f"{folder}/.{run}"), path(f"{folder}/{entry['number']:08d}.json")
    fs.mkdirs(path(folder))
    _write_text(spark, f"{folder}/.{run}", json.dumps(entry, indent=0))
    if fs.exists(final) or not fs.rename(draft, final):
        fs.delete(draft, False)
        raise RuntimeError(f"{month}: another run has published number {entry['number']} meanwhile")
    return entry


def published(spark: SparkSession, base: str, month: str) -> dict[str, DataFrame]:
    """The month's tables as last published; none before the first publication."""
    found = manifest(spark, base, month)
    return {n: spark.read.parquet(f"{base}/{p}") for n, p in found["tables"].items()} if found else {}


def prune(spark: SparkSession, base: str, month: str, keep: int = 2) -> int:
    """Delete the runs that neither of the last ``keep`` manifests names (those of
    killed jobs too) and the manifests before them. Not while a run is under way."""
    names = _manifests(spark, base, month)
    wanted = set()
    for n in names[-keep:]:
        wanted.add(json.loads("\n".join(r.value for r in spark.read.text(f"{base}/_manifests/{month}/{n}").collect()))["run"])
    gone, runs = 0, f"{base}/_runs/{month}"
    for run in _listdir(spark, runs) if path_exists(spark, runs) else []:
        if run not in wanted:
            fs, p = _fs(spark, f"{runs}/{run}")
            gone += bool(fs.delete(p, True))
    for n in names[:-keep]:
        fs, p = _fs(spark, f"{base}/_manifests/{month}/{n}")
        fs.delete(p, False)
    return gone
