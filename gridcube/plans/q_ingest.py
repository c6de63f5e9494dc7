"""Queries: file scans through the registry, months, profiles, ingest."""

from __future__ import annotations

import os
import uuid
from functools import reduce

import pyarrow as pa
from pyspark.sql import functions as F

from gridcube import incremental, jobs
from gridcube.operators import indicators as I
from gridcube.plans import analogues as A
from gridcube.plans import sqlgen as G
from gridcube.plans.catalog import register
from gridcube.session import scratch_path
from gridcube.sources import files as FS
from gridcube.sources import quarantine
from gridcube.sources.registry import CUBE_ORDER, SOURCES
from gridcube.streaming import ingest as ING

EXPORT_MONTH = "2025-11"
EXPORTED = list(CUBE_ORDER)


def _scratch(spark, tag):
    """A fresh folder under the session's shared checkpoint directory."""
    return scratch_path(spark, f"{tag}-{uuid.uuid4().hex[:12]}")


def export_month(spark, sf_dir, names=EXPORTED, month=EXPORT_MONTH) -> str:
    """Write analogue sources as monthly CSV exports (raw headers, file names
    from the registry) into ``<scratch>/<month>/`` and return the base."""
    base = _scratch(spark, "exports")
    folder = os.path.join(base, month)
    for name in names:
        spec = SOURCES[name]
        df = A.SOURCE_BUILDERS[name](spark, sf_dir).select(*spec.canonical)
        FS.export_csv(df, os.path.join(folder, spec.file_name(month)), spec.raw)
    return base


@register("scan_source", G.with_clause(G.base_ctes(["awc"]) + G.indicator_ctes("awc")[0]) + "\nSELECT * FROM ind_awc")
def q_scan_source(spark, sf_dir):
    """Export one source to CSV, scan it back under its header contract and
    run its indicator function: must equal the in-memory path."""
    base = export_month(spark, sf_dir, ["awc"])
    path = FS.resolve_files(spark, os.path.join(base, EXPORT_MONTH), EXPORT_MONTH, ["awc"])["awc"]
    return I.readiness(FS.scan_csv(spark, path, SOURCES["awc"]))


# the engine's type names from DuckDB's; max keeps it an aggregate
_DTYPE = "max(CASE typeof({0}) WHEN 'BIGINT' THEN 'bigint' WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' WHEN 'DATE' THEN 'date' WHEN 'INTEGER' THEN 'int' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE typeof({0}) END)"


def _profile_sql():
    parts = []
    for name in EXPORTED:
        for col in G.source_names(name):
            parts.append(f"SELECT '{name}' AS source, '{col}' AS \"column\", {_DTYPE.format(G.qi(col))} AS dtype, CAST(count(*) AS BIGINT) AS rows, "
                         f"CAST(count(*) FILTER (WHERE {G.qi(col)} IS NULL) AS BIGINT) AS missing FROM src_{name}")
    return G.with_clause(G.base_ctes(EXPORTED)) + "\n" + "\nUNION ALL\n".join(parts)


@register("scan_all_profile", _profile_sql())
def q_scan_all_profile(spark, sf_dir):
    """Export all ten sources into a month folder, discover the latest month
    folder, resolve every registered source's file in it, scan and profile
    each one (one aggregate per table, unioned)."""
    base = export_month(spark, sf_dir)
    month = FS.latest_month_folder(spark, base)
    tables = FS.scan_folder(spark, os.path.join(base, month), month, with_metadata=False)
    parts = [FS.profile_table(df, name) for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("profile_table", "SELECT 'orders' AS source, c AS \"column\", dtype, rows, missing FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS c, {_DTYPE.format(c)} AS dtype, CAST(count(*) AS BIGINT) AS rows, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS missing FROM orders"
    for c in ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]) + ")")
def q_profile_table(spark, sf_dir):
    return FS.profile_table(A.table(spark, sf_dir, "orders"), "orders")


@register("table_preview", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5")
def q_table_preview(spark, sf_dir):
    o = A.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return FS.table_preview(o, [F.col("o_totalprice").desc(), F.col("o_orderkey")])


def _ship_month(spark, sf_dir):
    return A.table(spark, sf_dir, "lineitem").withColumn("month", F.date_format("l_shipdate", "yyyy-MM"))


_MONTH_SQL = "strftime(l_shipdate, '%Y-%m')"


@register("list_months", f"SELECT {_MONTH_SQL} AS month, CAST(count(*) AS BIGINT) AS rows FROM lineitem "
                         f"WHERE regexp_full_match({_MONTH_SQL}, '\\d{{4}}-\\d{{2}}') GROUP BY 1")
def q_list_months(spark, sf_dir):
    return FS.months_of(_ship_month(spark, sf_dir))


@register("latest_month_slice", f"""
SELECT n.n_name, {_MONTH_SQL} AS month, CAST(count(*) AS BIGINT) AS rows
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey
WHERE {_MONTH_SQL} = (SELECT max({_MONTH_SQL}) FROM lineitem) GROUP BY 1, 2""")
def q_latest_month_slice(spark, sf_dir):
    li = FS.latest_month_of(A.table(spark, sf_dir, "lineitem"), "l_shipdate").withColumn("month", F.date_format("l_shipdate", "yyyy-MM"))
    sup = A.table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nat = A.table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = li.join(sup, li.l_suppkey == sup.s_suppkey).join(nat, F.col("s_nationkey") == F.col("n_nationkey"))
    return j.groupBy("n_name", "month").agg(F.count(F.lit(1)).cast("long").alias("rows"))


@register("resolve_projection_month", f"""
SELECT {_MONTH_SQL} AS month, strftime(CAST({_MONTH_SQL} || '-01' AS DATE) + INTERVAL 1 MONTH, '%Y-%m') AS projection_month,
       CAST(count(*) AS BIGINT) AS rows
FROM lineitem GROUP BY 1, 2""")
def q_resolve_projection_month(spark, sf_dir):
    m = FS.months_of(_ship_month(spark, sf_dir))
    return m.select("month", FS.projection_month("month").alias("projection_month"), "rows")


_EVENT_CLEAN_SQL = """
SELECT strftime(ts, '%Y-%m') AS month, 'events' AS source, event_type, CAST(count(*) AS BIGINT) AS rows
FROM (SELECT DISTINCT event_id, ts, user_id, trim(event_type) AS event_type, value, trim(props) AS props FROM events)
GROUP BY 1, 2, 3"""


@register("ingest_month", _EVENT_CLEAN_SQL)
def q_ingest_month(spark, sf_dir):
    ev = ING.ingest_batch(A.table(spark, sf_dir, "events"), "ts", "events")
    return ev.groupBy("month", "source", "event_type").agg(F.count(F.lit(1)).cast("long").alias("rows"))


@register("ingest_month_stream", _EVENT_CLEAN_SQL)
def q_ingest_month_stream(spark, sf_dir):
    """The same ingest as a file stream (availableNow + foreachBatch) into a
    month-partitioned table under the shared checkpoint folder."""
    base = _scratch(spark, "ingest")
    schema = A.table(spark, sf_dir, "events").schema
    ING.ingest_stream(spark, sf_dir, schema, os.path.join(base, "table"), os.path.join(base, "_checkpoint"),
                      "ts", "events", glob="events.parquet")
    ev = ING.read_ingested(spark, os.path.join(base, "table"))
    return ev.groupBy("month", "source", "event_type").agg(F.count(F.lit(1)).cast("long").alias("rows"))


@register("ingest_late_batches", """
SELECT strftime(ts, '%Y-%m') AS month, CASE WHEN event_id % 5 = 0 THEN 0 ELSE event_id % 3 END AS batch_id, CAST(count(*) AS BIGINT) AS rows
FROM (SELECT DISTINCT event_id, ts, user_id, trim(event_type), value, trim(props) FROM events) GROUP BY 1, 2""")
def q_ingest_late_batches(spark, sf_dir):
    """Three batches that share a fifth of their rows, the last sent twice: a row
    is stored by the first batch that brings it. Each batch opens only the
    history of its own days."""
    ev = ING.ingest_batch(A.table(spark, sf_dir, "events"), "ts", "events")
    path = os.path.join(_scratch(spark, "late"), "table")
    for k in (0, 1, 2, 2):
        ING.write_batch(ev.where((F.col("event_id") % 3 == k) | (F.col("event_id") % 5 == 0)), k, path, F.dayofmonth("ts"))
    return spark.read.parquet(path).groupBy("month", F.col("batch_id").cast("long").alias("batch_id")).agg(F.count(F.lit(1)).cast("long").alias("rows"))


EXPORT_FULL = list(CUBE_ORDER)


@register("cube_from_exports", G.with_clause(G.cube_ctes(EXPORT_FULL)) +
          f"\nSELECT '{EXPORT_MONTH}' AS month, * FROM cube")
def q_cube_from_exports(spark, sf_dir):
    """The user's path end to end: all ten sources are written as monthly CSV
    files, the monthly ETL job cleans them into month-partitioned tables, and
    the cube is built from those tables. Must equal the in-memory cube."""
    raw = export_month(spark, sf_dir, EXPORT_FULL)
    etl = _scratch(spark, "etl")
    jobs.run_month(spark, raw, etl)
    tables = jobs.load_cleaned(spark, etl, EXPORT_MONTH, EXPORT_FULL)
    return jobs.build_month_cube(tables, EXPORT_FULL, strict=True)


@register("cube_published", G.with_clause(G.cube_ctes(EXPORT_FULL)) + f"\nSELECT '{EXPORT_MONTH}' AS month, * FROM cube")
def q_cube_published(spark, sf_dir):
    """All ten sources as exports, published twice as one month (the first time
    without three of them), and the cube of what readers then see."""
    raw, base = export_month(spark, sf_dir, EXPORT_FULL), _scratch(spark, "published")
    jobs.publish_month(spark, raw, base, names=EXPORT_FULL[:-3])
    jobs.publish_month(spark, raw, base, names=EXPORT_FULL)
    return jobs.build_month_cube(jobs.load_published(spark, base, EXPORT_MONTH), EXPORT_FULL, strict=True)


@register("cube_incremental", G.with_clause(G.cube_ctes(EXPORT_FULL)) + f"\nSELECT '{EXPORT_MONTH}' AS month, * FROM cube")
def q_cube_incremental(spark, sf_dir):
    """A month taken in with wrong counts for some districts, a district too many
    and a wrong total, then corrected source by source: the cube equals a build
    from the right tables."""
    facts = A.Facts.for_sources(spark, sf_dir, EXPORT_FULL)
    right = {s: A.SOURCE_BUILDERS[s](spark, sf_dir, facts) for s in EXPORT_FULL}
    off = F.when(F.col("district").endswith("1"), 5).otherwise(0)
    wrong = dict(right)
    wrong["anaemia"] = right["anaemia"].withColumn("anaemic_pw", (F.col("anaemic_pw") + off).cast("long"))
    wrong["gm_5_6"] = right["gm_5_6"].unionByName(right["gm_5_6"].limit(1).withColumn("district", F.lit("Nowhere")))
    wrong["me"] = right["me"].withColumn("aww_completed_80pct_me", (F.col("aww_completed_80pct_me") * 2 + off).cast("long"))
    base = _scratch(spark, "incremental")
    incremental.update(spark, base, EXPORT_MONTH, wrong)
    for s in ("anaemia", "gm_5_6", "me"):
        incremental.update(spark, base, EXPORT_MONTH, {s: right[s]})
    return incremental.cube(spark, base, EXPORT_MONTH)


_BAD_TOTAL = "CASE WHEN c_custkey % 7 = 0 THEN concat('x', CAST(c_custkey AS STRING)) ELSE CAST(c_custkey AS STRING) END"


@register("ingest_quarantine", """
SELECT 'rows' AS what, CAST(count(*) AS BIGINT) AS n, CAST(sum(c_custkey) AS BIGINT) AS total FROM customer WHERE c_custkey % 7 <> 0 AND c_custkey % 11 <> 0
UNION ALL SELECT 'no number', CAST(count(*) AS BIGINT), NULL FROM customer WHERE c_custkey % 7 = 0 AND c_custkey % 11 <> 0
UNION ALL SELECT 'malformed', CAST(count(*) AS BIGINT), NULL FROM customer WHERE c_custkey % 11 = 0""")
def q_ingest_quarantine(spark, sf_dir):
    """An export with texts for numbers and lines that lack fields or have too
    many: the good lines are read, the others counted by reason."""
    spec = SOURCES["lbw"]
    c = A.table(spark, sf_dir, "customer")
    cells = [F.col("c_name"), F.expr(_BAD_TOTAL), F.lit("1")]
    line = F.concat_ws(",", *cells, *[F.lit("0")] * (len(spec.raw) - 3))
    lines = c.select(F.when(F.col("c_custkey") % 22 == 0, F.concat(line, F.lit(",9"))).when(F.col("c_custkey") % 11 == 0, "cut").otherwise(line).alias("line"))
    head = ",".join(spec.raw)

    def with_header(batches):
        for i, b in enumerate(batches):
            if not i:
                yield pa.RecordBatch.from_arrays([pa.array([head], b.schema.field(0).type)], schema=b.schema)
            yield b
    path = os.path.join(_scratch(spark, "bad"), "lbw.csv")
    lines.mapInArrow(with_header, "line string").write.text(path)
    rows, bad = quarantine.scan_lines(spark, path, spec)
    total = spec.canonical[1]
    good = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(total).cast("long").alias("total")).select(F.lit("rows").alias("what"), "n", "total")
    why = F.when(F.col("reason").startswith("wrong number"), "malformed").otherwise("no number")
    return good.unionByName(bad.groupBy(why.alias("what")).agg(F.count(F.lit(1)).alias("n")).withColumn("total", F.lit(None).cast("long")))


@register("cube_mixed_months", G.with_clause(G.cube_ctes(CUBE_ORDER, monthly=True)) + "\nSELECT * FROM cube")
def q_cube_mixed_months(spark, sf_dir):
    """The cube job over many months at once, where some sources are dated
    and others (customers, suppliers) are static and join on the district."""
    facts = A.Facts.for_sources(spark, sf_dir, CUBE_ORDER, monthly=True)
    tables = {s: A.SOURCE_BUILDERS[s](spark, sf_dir, facts) for s in CUBE_ORDER}
    return jobs.build_month_cube(tables, CUBE_ORDER, strict=True)


@register("cube_from_centres", G.with_clause(G.base_ctes(["lbw", "awc"]) + G.indicator_ctes("lbw")[0] + G.indicator_ctes("awc")[0]) + """
SELECT l.*, a.* EXCLUDE (district) FROM ind_lbw l LEFT JOIN ind_awc a USING (district)""")
def q_cube_from_centres(spark, sf_dir):
    """Sources that arrive per centre (here per nation and market segment)
    are summed to the entity before any ratio is formed."""
    c = A.table(spark, sf_dir, "customer").join(A.nations(spark, sf_dir), F.col("c_nationkey") == F.col("nationkey"))
    per = c.groupBy("n_name", "c_mktsegment").agg(*[A.cnt(v).alias(k) for k, v in A.CUST_FLAGS.items()])
    lbw = per.select(F.lower("n_name").alias("district"), F.col("c_all").alias("total_children_0_6m"), F.col("neg").alias("lbw_children_0_6m"))
    awc = per.select(F.concat("n_name", F.lit("\t")).alias("district"), F.col("c_all").alias("total_awc"), F.col("pos").alias("active_awc"),
                     F.col("nonpos").alias("inactive_awc"), F.col("rich").alias("new_awc_month"), F.col("deep").alias("inactive_awc_month"))
    return jobs.build_month_cube({"lbw": lbw, "awc": awc}, ["lbw", "awc"], strict=True, grain=True)


WIDE, OTHER = "lbw", "Nations_Extra.csv"


def _report_sql():
    parts = []
    for s in SOURCES.values():
        there = s.name in EXPORTED
        rows = f"(SELECT CAST(count(*) AS BIGINT) FROM src_{s.name})" if there else "CAST(NULL AS BIGINT)"
        parts.append(f"SELECT '{s.file_name(EXPORT_MONTH)}' AS file, '{s.name}' AS source, '{'loaded' if there else 'missing'}' AS status, "
                     f"CAST({int(s.name == WIDE)} AS BIGINT) AS extra_columns, {rows} AS rows")
    parts.append(f"SELECT '{OTHER}', '{OTHER[:-4]}', 'unknown', CAST(0 AS BIGINT), (SELECT CAST(count(*) AS BIGINT) FROM nation)")
    return G.with_clause(G.base_ctes(EXPORTED)) + "\n" + "\nUNION ALL\n".join(parts)


@register("ingest_report", _report_sql())
def q_ingest_report(spark, sf_dir):
    """A month folder with a source whose export gained a column, a CSV no
    contract names, and sources that are missing: the report lists each, and
    every CSV there is scanned (rows counted after the scan)."""
    base = export_month(spark, sf_dir)
    folder = os.path.join(base, EXPORT_MONTH)
    spec = SOURCES[WIDE]
    wide = A.SOURCE_BUILDERS[WIDE](spark, sf_dir).select(*spec.canonical).withColumn("remark", F.lit("new"))
    FS.export_csv(wide, os.path.join(folder, spec.file_name(EXPORT_MONTH)), [*spec.raw, "Remark"])
    nation = A.table(spark, sf_dir, "nation")
    FS.export_csv(nation, os.path.join(folder, OTHER), nation.columns)
    tables = FS.scan_folder(spark, folder, EXPORT_MONTH)
    counts = reduce(lambda a, b: a.unionByName(b),
                    [df.select("source").groupBy("source").agg(F.count(F.lit(1)).cast("long").alias("rows")) for df in tables.values()])
    return FS.folder_report(spark, folder, EXPORT_MONTH).join(counts, "source", "left") \
        .select("file", "source", "status", "extra_columns", "rows")


BROKEN = "awc"


def _broken_export(spark, sf_dir) -> str:
    """A month folder with one source as it should be and one whose second
    header is another's."""
    base = export_month(spark, sf_dir, [WIDE])
    spec = SOURCES[BROKEN]
    df = A.SOURCE_BUILDERS[BROKEN](spark, sf_dir).select(*spec.canonical)
    FS.export_csv(df, os.path.join(base, EXPORT_MONTH, spec.file_name(EXPORT_MONTH)), [spec.raw[0], "Something Else", *spec.raw[2:]])
    return os.path.join(base, EXPORT_MONTH)


_STATUS = {WIDE: "loaded", BROKEN: "mismatch"}


@register("schema_mismatch", " UNION ALL ".join(
    f"SELECT '{s.file_name(EXPORT_MONTH)}' AS file, '{s.name}' AS source, '{_STATUS.get(s.name, 'missing')}' AS status, CAST(0 AS BIGINT) AS extra_columns "
    "WHERE EXISTS (SELECT 1 FROM customer)" for s in SOURCES.values()))
def q_schema_mismatch(spark, sf_dir):
    """The folder report of an export that breaks its contract."""
    return FS.folder_report(spark, _broken_export(spark, sf_dir), EXPORT_MONTH)


@register("schema_contract", " UNION ALL ".join(
    f"SELECT '{BROKEN}' AS source, '{h}' AS expected, '{'Something Else' if i == 1 else h}' AS found, {str(i != 1).lower()} AS present "
    "WHERE EXISTS (SELECT 1 FROM customer)" for i, h in enumerate(SOURCES[BROKEN].raw)))
def q_schema_contract(spark, sf_dir):
    """Column by column, what the contract expects and what the file has."""
    folder = _broken_export(spark, sf_dir)
    return FS.schema_contract(spark, os.path.join(folder, SOURCES[BROKEN].file_name(EXPORT_MONTH)), SOURCES[BROKEN])
