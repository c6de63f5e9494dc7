"""The monthly cube, kept up to date by corrections.

``base`` holds, per source and month, the entity-grain partials (counts that add
up), the cube, and a log of what changed, all but the log in folders by month and
by bucket of the entity. A corrected export is brought to the entity grain and
compared with its partials; only entities that changed are computed anew, joined
from all sources' partials of their buckets, and only the buckets they lie in are
written. Shares of a month's total depend on every entity: where the total moved,
all entities of that source are recomputed, and no other month is touched.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcube.jobs import entity_rows
from gridcube.operators.cube import build_cube
from gridcube.operators.indicators import INDICATORS
from gridcube.session import materialize
from gridcube.sources.files import path_exists
from gridcube.sources.registry import CUBE_ORDER, SOURCES

KEYS = ["month", "district"]
BUCKETS = 64
# the column whose share of the month's total a source reports
TOTALS = {"me": "aww_completed_80pct_me"}


def bucket_of(key="district"):
    return F.pmod(F.xxhash64(F.col(key)), F.lit(BUCKETS)).cast("int")


def _entity():
    """The key, with NULL as a value of its own."""
    return F.struct("district")


def _read(spark: SparkSession, base: str, month: str, buckets: list[int] | None = None) -> DataFrame | None:
    """A stored table's month, or some buckets of it; None where there is none."""
    paths = [f"{base}/month={month}"] if buckets is None else [f"{base}/month={month}/bucket={b}" for b in buckets]
    paths = [p for p in paths if path_exists(spark, p)]
    if not paths:
        return None
    return spark.read.option("basePath", base).parquet(*paths).withColumn("month", F.lit(month)).drop("bucket")


def _replace(spark: SparkSession, rows: DataFrame, base: str, month: str, buckets: list[int]) -> None:
    """Write ``rows`` as the month's ``buckets``; those that are left empty go."""
    rows = materialize(rows.withColumn("bucket", bucket_of()), "buckets")        # they may come from the folders they replace
    filled = {r.bucket for r in rows.select("bucket").distinct().collect()}
    for b in buckets:
        path = f"{base}/month={month}/bucket={b}"
        if b not in filled and path_exists(spark, path):
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    if filled:
        rows.withColumn("month", F.lit(month)).hint("rebalance", "bucket").write.mode("overwrite") \
            .option("partitionOverwriteMode", "dynamic").partitionBy("month", "bucket").parquet(base)


def _changes(new: DataFrame, old: DataFrame | None) -> DataFrame:
    """(district, change) of the entities that differ between two tables of
    entity-grain rows: added, removed or changed."""
    cols = [c for c in new.columns if c not in KEYS]
    side = lambda df, tag: df.select("district", F.xxhash64(*[F.col(f"`{c}`") for c in cols]).alias("h"), F.xxhash64(F.lit("g"), *[F.col(f"`{c}`") for c in cols]).alias("g"),
                                     F.lit(tag).alias("s"))
    both = side(new, 1) if old is None else side(new, 1).unionByName(side(old.select(*new.columns), 0))
    now, then = (F.sort_array(F.collect_list(F.when(F.col("s") == t, F.struct("h", "g")))) for t in (1, 0))
    g = both.groupBy("district").agg(now.alias("now"), then.alias("then")).where("now <> then")
    return g.select("district", F.when(F.size("then") == 0, "added").when(F.size("now") == 0, "removed").otherwise("changed").alias("change"))


def update(spark: SparkSession, base: str, month: str, exports: dict[str, DataFrame], order: list[str] | None = None) -> DataFrame:
    """Take in the month's complete new ``exports`` of some sources (all of them
    the first time) and bring the cube up to date. Returns the run's log: (run,
    month, source, district, change); a source whose total moved logs its other
    entities as ``share``. A run that died is simply repeated: what it had already
    stored is found unchanged only once the cube was written, as partials go last."""
    order, run = list(order or CUBE_ORDER), uuid.uuid4().hex[:12]
    new, logs = {}, []
    for s, df in exports.items():
        rows = entity_rows(df.withColumn("month", F.lit(month)) if "month" not in df.columns else df, s, KEYS)
        new[s] = materialize(rows.withColumn("month", F.lit(month)).select("month", *[c for c in rows.columns if c != "month"]), f"partial-{s}")
        old = _read(spark, f"{base}/partials/{s}", month)
        found = materialize(_changes(new[s], old), "changes")
        total = TOTALS.get(s)
        if total and old is not None and new[s].agg(F.sum(total)).first()[0] != old.agg(F.sum(total)).first()[0]:
            rest = new[s].select("district").distinct().join(found.select(_entity().alias("e")), F.col("e") == _entity(), "left_anti")
            found = found.unionByName(rest.withColumn("change", F.lit("share")))
        logs.append(found.select(F.lit(run).alias("run"), F.lit(month).alias("month"), F.lit(s).alias("source"), "district", "change"))
    log = logs[0]
    for x in logs[1:]:
        log = log.unionByName(x)
    log = materialize(log, "log")
    touched = materialize(log.select("district").distinct().withColumn("bucket", bucket_of()), "touched")
    buckets = sorted(r.bucket for r in touched.select("bucket").distinct().collect())      # BUCKETS numbers at most
    if buckets:
        entities = touched.select(_entity().alias("__e"))
        frames = {}
        for s in order:
            src = new.get(s)
            if src is None:                      # a total needs its whole month, all else its buckets only
                src = _read(spark, f"{base}/partials/{s}", month, None if s in TOTALS else buckets)
                if src is None and (whole := _read(spark, f"{base}/partials/{s}", month)) is not None:
                    src = whole.limit(0)         # the source is there, though not in these buckets
            if src is None:
                if s == order[0]:
                    raise FileNotFoundError(f"base source {s!r} is missing for {month}")
                src = spark.createDataFrame([], SOURCES[s].schema()).withColumn("month", F.lit(None).cast("string"))
            frames[s] = INDICATORS[s](src).join(entities, F.col("__e") == _entity(), "left_semi")
        fresh = build_cube(frames, order, KEYS)
        kept = _read(spark, f"{base}/cube", month, buckets)
        if kept is not None:
            fresh = fresh.unionByName(kept.join(entities, F.col("__e") == _entity(), "left_anti").select(*fresh.columns))
        _replace(spark, fresh, f"{base}/cube", month, buckets)
        for s, rows in new.items():
            mine = sorted({r.b for r in log.where((F.col("source") == s) & (F.col("change") != "share")).select(bucket_of().alias("b")).distinct().collect()})
            if mine:
                _replace(spark, rows.where(bucket_of().isin(mine)), f"{base}/partials/{s}", month, mine)
        log.write.mode("append").partitionBy("month").parquet(f"{base}/log")
    return log


def cube(spark: SparkSession, base: str, month: str | None = None) -> DataFrame:
    """The stored cube, of one month or of all."""
    df = spark.read.option("basePath", f"{base}/cube").parquet(f"{base}/cube" if month is None else f"{base}/cube/month={month}")
    df = df.withColumn("month", F.col("month").cast("string")).drop("bucket")
    return df.select(*KEYS, *[c for c in df.columns if c not in KEYS])
