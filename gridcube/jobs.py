"""End-to-end monthly jobs: folder of exports -> cleaned tables -> cube.

``run_month`` is the monthly ETL (S13): it finds the latest (or a given)
month folder, scans every registered source found there under its header
contract, cleans it and writes it as a month-partitioned table. ``run_cube``
(J4) builds the cube for a month from the exports (or from the cleaned
tables) and writes it partitioned by month. Reruns replace only their own
month (dynamic partition overwrite).
"""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridcube.functions import exprs as X
from gridcube.operators.clean import trim_strings
from gridcube.operators.cube import build_cube
from gridcube.operators.indicators import INDICATORS
from gridcube.operators.quality import unique_key
from gridcube.session import materialize
from gridcube.sources import files as FS
from gridcube.sources import publish, quarantine
from gridcube.sources.registry import CUBE_ORDER, SOURCES


# Percentages that exports give, as (column, part, whole): formed anew when rows are summed.
_BANDS = [f"{band}_{level}" for band in ("stunted", "underweight") for level in ("severe", "moderate", "normal")]
GIVEN = {
    **{s: [(f"{c}_pct{x}", f"{c}_n{x}", f"measured_children{x}") for c in _BANDS] +
          [(f"measurement_efficiency{x}", f"measured_children{x}", f"total_children{x}")]
       for s, x in (("gm_5_6", ""), ("gm_0_5", "_0_5"))},
    "me": [("children_measured_pct", "children_measured", "children_total")],
    "ag": [("ag_measured_pct", "ag_measured", "total_ag")],
    "hv": [("visit_coverage_pct", "visits_made", "target_visits")],
}


METADATA = ["source", "file_path"]


def scan_month(spark: SparkSession, raw_base: str, month: str | None = None,
               names: list[str] | None = None, with_metadata: bool = False) -> tuple[str, dict[str, DataFrame]]:
    """Resolve the month (latest folder when not given) and scan its sources."""
    month = month or FS.latest_month_folder(spark, raw_base)
    tables = FS.scan_folder(spark, os.path.join(raw_base, month), month, names, with_metadata)
    return month, {n: df.drop("month") for n, df in tables.items()} if with_metadata else tables


def clean_source(df: DataFrame, month: str) -> DataFrame:
    """Strip strings and drop rows that repeat another's data (whichever file
    they came from); tag the month."""
    rows = trim_strings(df)
    return rows.dropDuplicates([c for c in rows.columns if c not in METADATA]).withColumn("month", F.lit(month))


def run_month(spark: SparkSession, raw_base: str, out_base: str, month: str | None = None,
              names: list[str] | None = None) -> dict[str, str]:
    """Clean every CSV of a month, registered or not, and write it under
    ``out_base/<source>/month=<month>``, plus ``folder_report``'s rows under
    ``out_base/_report``. The tables keep the partitioning of their cleaning
    step, so a month is written by many tasks. Every row carries its source and
    file path. Returns source -> table path."""
    month, tables = scan_month(spark, raw_base, month, names, with_metadata=True)
    out = {}
    for name, df in tables.items():
        path = os.path.join(out_base, name)
        FS.write_table(clean_source(df, month), path, ["month"])
        out[name] = path
    report = FS.folder_report(spark, os.path.join(raw_base, month), month).withColumn("month", F.lit(month))
    FS.write_table(report, os.path.join(out_base, "_report"), ["month"])
    return out


def publish_month(spark: SparkSession, raw_base: str, out_base: str, month: str | None = None, names: list[str] | None = None,
                  max_bad: float = 0.05) -> dict:
    """S13 with bad lines set aside and all tables published together.

    Every registered source of the month is read line by line
    (``quarantine.scan_lines``): lines that cannot be read go, with file, line
    number and reason, to the table ``_quarantine``, and the month goes on unless a
    source has more than ``max_bad`` of them. The cleaned tables, the quarantine and
    ``_report`` (``folder_report`` with rows and bad lines) become visible together
    with one rename (``publish``); a job that dies before it leaves the former
    month. Returns the manifest; ``load_published`` reads it."""
    month = month or FS.latest_month_folder(spark, raw_base)
    folder = os.path.join(raw_base, month)
    tables, bad = {}, None
    for name, path in FS.resolve_files(spark, folder, month, names).items():
        if path is not None:
            rows, faults = quarantine.scan_lines(spark, path, SOURCES[name], max_bad)
            tables[name] = clean_source(rows.withColumn("source", F.lit(name)), month)
            bad = faults if bad is None else bad.unionByName(faults)
    if bad is None:
        bad = spark.createDataFrame([], quarantine.BAD)
    bad = materialize(bad, "quarantine")
    counts = [df.groupBy("source").agg(F.count(F.lit(1)).alias("rows")) for df in tables.values()]
    report = FS.folder_report(spark, folder, month)
    rows = reduce(lambda a, b: a.unionByName(b), counts) if counts else spark.createDataFrame([], "source string, rows long")
    report = report.join(rows, "source", "left").join(bad.groupBy("source").agg(F.count(F.lit(1)).alias("bad_lines")), "source", "left")
    return publish.publish(spark, out_base, month, {**tables, "_quarantine": bad, "_report": report.fillna(0, ["bad_lines"])})


def load_published(spark: SparkSession, base: str, month: str) -> dict[str, DataFrame]:
    """The month's cleaned tables as last published, ready for ``build_month_cube``
    (``publish.published`` has the quarantine and the report as well)."""
    return {n: df.drop(*METADATA) for n, df in publish.published(spark, base, month).items() if not n.startswith("_")}


def build_month_cube(tables: dict[str, DataFrame], order: list[str] | None = None,
                     strict: bool = False, grain: bool = False) -> DataFrame:
    """Indicators per source, then the left-join fold keyed by
    (month, district). A missing base source is an error. A source without a
    month (static) joins on the district alone; the others keep both keys.
    ``grain`` first brings sources that arrive below the entity grain to it
    (``entity_rows``: keys cleaned, counts summed, ratios of sums).

    ``strict`` first checks that every source is unique on the key (one job
    over all sources; only the per-source report reaches the driver) and
    raises instead of letting a duplicated key fan out the cube.

    A missing side source joins as an empty table with its contract schema,
    so its columns (derived ones included) are present and NULL: the cube's
    schema does not change from month to month (D16)."""
    order = list(order or CUBE_ORDER)
    if order[0] not in tables:
        raise FileNotFoundError(f"base source {order[0]!r} is missing for this month")
    spark = tables[order[0]].sparkSession
    with_month = "month" in tables[order[0]].columns
    full = {}
    for s in order:
        if s in tables:
            full[s] = tables[s]
        else:
            empty = spark.createDataFrame([], SOURCES[s].schema())
            full[s] = empty.withColumn("month", F.lit(None).cast("string")) if with_month else empty
    keys = ["month", "district"]
    if grain:
        full = {s: entity_rows(df, s, keys) for s, df in full.items()}
    frames = {s: INDICATORS[s](full[s]) for s in order}
    if strict:
        # a source without month (static) has to be unique on the district alone
        bad = []
        for on in (keys, keys[1:]):
            some = {s: f for s, f in frames.items() if ("month" in f.columns) == ("month" in on)}
            if some:
                bad += [(r.source, r.duplicate_keys) for r in unique_key(some, on).collect() if not r.passed]
        if bad:
            raise ValueError(f"sources not unique on their keys: {bad}")
    return build_cube(frames, order, keys)


def entity_rows(df: DataFrame, source: str, keys: list[str]) -> DataFrame:
    """A source at the entity grain: keys cleaned, rows of one key summed.

    A source that arrives per centre or per beneficiary has several rows of a
    key: their counts are summed and given percentages are formed anew from
    the sums where a rule is known (``GIVEN``), else NULL. A key with a single
    row keeps all of its values."""
    on = [k for k in keys if k in df.columns]
    rows = df.withColumn("district", X.clean_key("district"))
    rest = [f for f in df.schema.fields if f.name not in on]
    whole = (T.LongType, T.IntegerType, T.ShortType)
    n = F.count(F.lit(1))
    aggs = [F.sum(F.col(f"`{f.name}`")).cast(f.dataType).alias(f.name) if isinstance(f.dataType, whole)
            else F.when(n == 1, F.first(F.col(f"`{f.name}`"))).alias(f.name) for f in rest]
    out = rows.groupBy(*on).agg(*aggs, n.alias("__n"))
    given = {c: F.when(F.col("__n") == 1, F.col(c)).otherwise(X.pct(a, b).cast(df.schema[c].dataType))
             for c, a, b in GIVEN.get(source, ())}
    return out.withColumns(given).select(*df.columns) if given else out.select(*df.columns)


def run_cube(spark: SparkSession, raw_base: str, out_path: str | None = None, month: str | None = None,
             order: list[str] | None = None, strict: bool = True, grain: bool = False) -> DataFrame:
    """Build the month's cube from its exports; write it partitioned by
    month when ``out_path`` is given. Returns the cube DataFrame."""
    month, tables = scan_month(spark, raw_base, month, order)
    tagged = {n: df.withColumn("month", F.lit(month)) for n, df in tables.items()}
    cube = build_month_cube(tagged, order, strict, grain)
    if out_path:
        FS.write_table(cube, out_path, ["month"], one_file_per_partition=True)
        return spark.read.parquet(out_path).where(F.col("month") == month).select(*cube.columns)
    return cube


def load_cleaned(spark: SparkSession, etl_base: str, month: str,
                 names: list[str] | None = None, with_metadata: bool = False) -> dict[str, DataFrame]:
    """Read the cleaned tables of one month (partition-pruned). A source that
    has no rows for the month has no partition and is left out."""
    out = {}
    for name in names or list(SOURCES):
        path = os.path.join(etl_base, name)
        if FS.path_exists(spark, os.path.join(path, f"month={month}")):
            df = spark.read.parquet(path).where(F.col("month") == month)
            out[name] = df if with_metadata else df.drop(*METADATA)
    return out
