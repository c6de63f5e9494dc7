"""Queries: the month-keyed cube and its month-partitioned table."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from gridcube.operators import cube as C
from gridcube.plans import analogues as A
from gridcube.plans import sqlgen as G
from gridcube.plans.catalog import register
from gridcube.plans.q_cube import indicator_frame
from gridcube.session import scratch_path
from gridcube.sources import files as FS
from gridcube.sources.registry import CUBE_ORDER

MONTH_KEYS = ["month", "district"]
MONTHLY_CTES = G.cube_ctes(CUBE_ORDER, monthly=True)


def monthly_cube(spark, sf_dir, order=CUBE_ORDER, days=None):
    """The cube keyed by (month, district): dated sources (lineitem by ship
    month, orders by order month) carry a month; static sources (customer,
    supplier) join on the district alone. Each fact table is still scanned
    once, and the month-keyed aggregates are materialised in one job."""
    facts = A.Facts.for_sources(spark, sf_dir, order, monthly=True, days=days)
    frames = {s: indicator_frame(spark, sf_dir, s, facts) for s in order}
    return C.build_cube(frames, list(order), MONTH_KEYS)


@register("district_cube_monthly", G.with_clause(MONTHLY_CTES) + "\nSELECT * FROM cube")
def q_district_cube_monthly(spark, sf_dir):
    return monthly_cube(spark, sf_dir)


@register("cube_latest_month", G.with_clause(MONTHLY_CTES) +
          "\nSELECT * FROM cube WHERE month = (SELECT max(month) FROM cube)")
def q_cube_latest_month(spark, sf_dir):
    """The month comes first: the latest ship date (one column, one value) gives
    its month's first and last day, and only those days of the facts are read
    (plain bounds at the scan). The cube is written as a month partition
    (dynamic overwrite) and read back from the table's latest partition."""
    last = A.table(spark, sf_dir, "lineitem").agg(F.trunc(F.max("l_shipdate"), "month").alias("d")) \
        .select("d", F.add_months("d", 1).alias("e")).first()
    path = scratch_path(spark, f"cube-{uuid.uuid4().hex[:12]}")
    FS.write_table(monthly_cube(spark, sf_dir, days=tuple(last)), path, ["month"], one_file_per_partition=True)
    stored = spark.read.parquet(path)
    latest = FS.latest_month_slice(stored, "month")
    return latest.select(*[c for c in latest.columns if c != "month"], "month")


def _corr_monthly_sql():
    from gridcube.operators.serve import CORRELATE_COLUMNS
    from gridcube.plans.q_stats import _legacy_sql_cols
    cols = dict(_legacy_sql_cols())
    sel = ", ".join(f"{cols[c]} AS {G.qi(c)}" for c in CORRELATE_COLUMNS)
    ctes = MONTHLY_CTES + [("legacy_m", f"SELECT month, district AS District, {sel} FROM cube")]
    where = " AND ".join(f"{G.qi(c)} IS NOT NULL AND NOT isnan({G.qi(c)})" for c in CORRELATE_COLUMNS)
    parts = []
    for i, a in enumerate(CORRELATE_COLUMNS):
        for j, b in enumerate(CORRELATE_COLUMNS):
            if j <= i:
                continue
            parts.append(
                f"SELECT month, '{a}' AS indicator_a, '{b}' AS indicator_b, CAST({i} AS BIGINT) AS pos_a, "
                f"CAST({j} AS BIGINT) AS pos_b, {G.rnd(G.corr(G.qi(a), G.qi(b)), 6)} AS correlation, "
                f"CAST(count(*) AS BIGINT) AS n_rows FROM legacy_m WHERE {where} GROUP BY month")
    return G.with_clause(ctes) + "\n" + "\nUNION ALL\n".join(parts)


@register("corr_pairs_monthly", _corr_monthly_sql())
def q_corr_pairs_monthly(spark, sf_dir):
    """The correlation report for every month of the month-keyed cube in one
    long-form aggregate grouped by (month, pair)."""
    from gridcube.operators import serve as SV
    from gridcube.operators import stats as ST
    from gridcube.plans.q_cube import materialize
    view = materialize(SV.legacy_view(monthly_cube(spark, sf_dir)))
    return ST.corr_pairs_listwise(view, SV.CORRELATE_COLUMNS, by=["month"])
