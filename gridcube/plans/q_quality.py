"""Queries: data-quality reconciliation over the cube and its sources."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridcube.functions import exprs as X
from gridcube.operators import clean as CL
from gridcube.operators import quality as Q
from gridcube.plans import analogues as A
from gridcube.plans import sqlgen as G
from gridcube.plans.catalog import register
from gridcube.plans.q_cube import district_cube, indicator_frames
from gridcube.session import materialize as write_and_read
from gridcube.sources.registry import CUBE_ORDER

ALL_CTES = G.cube_ctes(CUBE_ORDER)
WITH_ALL = G.with_clause(ALL_CTES)


def _planted_dup(frames):
    return frames["gm_5_6"].select("district").unionByName(frames["anaemia"].select("district"))


PLANTED_DUP_SQL = "(SELECT district FROM ind_gm_5_6 UNION ALL SELECT district FROM ind_anaemia)"


def _uniq_sql(name, rel):
    return (f"SELECT '{name}' AS source, CAST(sum(n) AS BIGINT) AS rows, CAST(count(*) AS BIGINT) AS distinct_keys, "
            f"CAST(count(*) FILTER (WHERE n > 1) AS BIGINT) AS duplicate_keys "
            f"FROM (SELECT district, count(*) AS n FROM {rel} GROUP BY district)")


@register("dq_unique_key", WITH_ALL + "\nSELECT *, duplicate_keys = 0 AS passed FROM (\n" + "\nUNION ALL\n".join(
    [_uniq_sql(s, f"ind_{s}") for s in CUBE_ORDER] + [_uniq_sql("cube", "cube"), _uniq_sql("planted_dup", PLANTED_DUP_SQL)]) + ")")
def q_dq_unique_key(spark, sf_dir):
    facts = A.Facts.for_sources(spark, sf_dir, CUBE_ORDER)
    fr = indicator_frames(spark, sf_dir, facts=facts)
    frames = dict(fr)
    frames["cube"] = district_cube(spark, sf_dir, facts=facts)
    frames["planted_dup"] = _planted_dup(fr)
    return Q.unique_key(frames, ["district"])


@register("dq_row_preservation", WITH_ALL + f"""
SELECT 'cube' AS "check", (SELECT CAST(count(*) AS BIGINT) FROM ind_gm_5_6) AS base_rows,
       (SELECT CAST(count(*) AS BIGINT) FROM cube) AS result_rows,
       (SELECT count(*) FROM ind_gm_5_6) = (SELECT count(*) FROM cube) AS passed
UNION ALL
SELECT 'planted_fanout', (SELECT CAST(count(*) AS BIGINT) FROM ind_gm_5_6),
       (SELECT CAST(count(*) AS BIGINT) FROM ind_gm_5_6 b LEFT JOIN {PLANTED_DUP_SQL} p ON b.district = p.district),
       (SELECT count(*) FROM ind_gm_5_6) =
       (SELECT count(*) FROM ind_gm_5_6 b LEFT JOIN {PLANTED_DUP_SQL} p ON b.district = p.district)""")
def q_dq_row_preservation(spark, sf_dir):
    facts = A.Facts.for_sources(spark, sf_dir, CUBE_ORDER)
    fr = indicator_frames(spark, sf_dir, facts=facts)
    base = fr["gm_5_6"]
    fan = base.join(_planted_dup(fr).withColumn("dup", F.lit(1)), "district", "left")
    return (Q.row_preservation(base, district_cube(spark, sf_dir, facts=facts), "cube")
            .unionByName(Q.row_preservation(base, fan, "planted_fanout")))


def _ref_sql(name, rel):
    return (f"SELECT '{name}' AS source, CAST(count(*) AS BIGINT) AS orphan_keys, min(k) AS first_orphan FROM "
            f"(SELECT DISTINCT district AS k FROM {rel} WHERE district IS NOT NULL "
            f"EXCEPT SELECT DISTINCT district FROM ind_gm_5_6)")


_GM05_KEYS = f"(SELECT {G.clean_key('district')} AS district FROM src_gm_0_5)"


@register("dq_referential", WITH_ALL + "\nSELECT *, orphan_keys = 0 AS passed FROM (\n" + "\nUNION ALL\n".join(
    [_ref_sql(s, f"ind_{s}") for s in CUBE_ORDER] + [_ref_sql("gm_0_5_with_rollup", _GM05_KEYS)]) + ")")
def q_dq_referential(spark, sf_dir):
    facts = A.Facts.for_sources(spark, sf_dir, CUBE_ORDER)
    fr = indicator_frames(spark, sf_dir, facts=facts)
    frames = dict(fr)
    frames["gm_0_5_with_rollup"] = CL.clean_key_column(A.src_gm_0_5(spark, sf_dir, facts).select("district"))
    return Q.referential(frames, fr["gm_5_6"], "district")


_NULLY = ("CASE WHEN c_acctbal < -900 THEN NULL WHEN c_acctbal > 9900 THEN repeat(' ', 1 + CAST(c_custkey % 3 AS INT)) "
          "ELSE c_name END")


def _nb_sql(name, rel):
    return (f"SELECT '{name}' AS source, CAST(count(*) FILTER (WHERE district IS NULL) AS BIGINT) AS null_keys, "
            f"CAST(count(*) FILTER (WHERE district IS NOT NULL AND trim(district) = '') AS BIGINT) AS blank_keys "
            f"FROM {rel}")


@register("dq_null_blank", WITH_ALL + "\nSELECT *, null_keys = 0 AND blank_keys = 0 AS passed FROM (\n" +
          "\nUNION ALL\n".join([_nb_sql(s, f"ind_{s}") for s in CUBE_ORDER] +
                               [_nb_sql("planted_customers", f"(SELECT {_NULLY} AS district FROM customer)")]) + ")")
def q_dq_null_blank(spark, sf_dir):
    frames = dict(indicator_frames(spark, sf_dir))
    frames["planted_customers"] = A.table(spark, sf_dir, "customer").select(F.expr(_NULLY).alias("district"))
    return Q.null_blank(frames, "district")


RECON_TABLES = {
    "region": ["r_name"], "nation": ["n_name"], "customer": ["c_name", "c_mktsegment"],
    "supplier": ["s_name"], "part": ["p_name", "p_brand", "p_type"],
    "orders": ["o_orderstatus", "o_orderpriority"], "lineitem": ["l_returnflag", "l_linestatus"],
    "events": ["event_type", "props"],
}


def _recon_sql():
    parts = []
    for t, strs in RECON_TABLES.items():
        rep = ", ".join(f"trim({c}) AS {c}" for c in strs)
        parts.append(f"SELECT '{t}' AS source, CAST((SELECT count(*) FROM {t}) AS BIGINT) AS raw_rows, "
                     f"CAST((SELECT count(*) FROM (SELECT DISTINCT * REPLACE ({rep}) FROM {t})) AS BIGINT) AS clean_rows")
    parts.append("SELECT 'planted_loss', CAST((SELECT count(*) FROM supplier) AS BIGINT), "
                 "CAST((SELECT count(*) FROM supplier WHERE s_suppkey % 7 <> 0) AS BIGINT)")
    parts.append("SELECT 'planted_absent', CAST((SELECT count(*) FROM nation) AS BIGINT), NULL")
    return ("SELECT *, raw_rows - clean_rows AS diff, coalesce(raw_rows - clean_rows = 0, false) AS passed FROM (\n"
            + "\nUNION ALL\n".join(parts) + ")")


@register("dq_rowcount_reconcile", _recon_sql())
def q_dq_rowcount_reconcile(spark, sf_dir):
    """Raw tables against what the cleaning job stored (written, then read
    back), with a table that lost rows and one that was never stored."""
    raw = {t: A.table(spark, sf_dir, t) for t in RECON_TABLES}
    clean = {t: write_and_read(CL.basic_clean(df), f"clean-{t}") for t, df in raw.items()}
    raw |= {"planted_loss": raw["supplier"], "planted_absent": raw["nation"]}
    clean["planted_loss"] = write_and_read(raw["supplier"].where("s_suppkey % 7 <> 0"), "clean-planted")
    return Q.rowcount_reconcile(raw, clean)


def _cov_sql(name):
    return (f"SELECT '{name}' AS source, CAST(count(*) AS BIGINT) AS base_keys, "
            f"CAST(count(*) FILTER (WHERE p.k IS NULL) AS BIGINT) AS missing "
            f"FROM (SELECT DISTINCT district AS k FROM ind_gm_5_6) b "
            f"LEFT JOIN (SELECT DISTINCT district AS k FROM ind_{name}) p ON b.k = p.k")


@register("dq_coverage_gap", WITH_ALL + "\nSELECT *, base_keys - missing AS covered, missing = 0 AS passed FROM (\n" +
          "\nUNION ALL\n".join(_cov_sql(s) for s in CUBE_ORDER[1:]) + ")")
def q_dq_coverage_gap(spark, sf_dir):
    fr = indicator_frames(spark, sf_dir)
    return Q.coverage_gap(fr["gm_5_6"], {s: fr[s] for s in CUBE_ORDER[1:]}, "district")


@register("dq_rebuild_match", WITH_ALL + """
SELECT 'rebuild' AS "check", CAST(count(*) AS BIGINT) AS rows_a, CAST(count(*) AS BIGINT) AS rows_b, CAST(0 AS BIGINT) AS a_minus_b,
       CAST(0 AS BIGINT) AS b_minus_a, true AS hash_equal, true AS passed FROM cube
UNION ALL
SELECT 'planted', CAST(count(*) AS BIGINT), CAST(count(*) FILTER (WHERE district NOT LIKE '%1') AS BIGINT),
       CAST(count(*) FILTER (WHERE district LIKE '%1' OR district LIKE '%2') AS BIGINT),
       CAST(count(*) FILTER (WHERE district LIKE '%2') AS BIGINT), false, false FROM cube""")
def q_dq_rebuild_match(spark, sf_dir):
    """Two independent builds of the cube (separate plans, separate scans,
    separately materialised fact aggregates), and the build against a copy
    that lacks some districts and has another count in others."""
    first = district_cube(spark, sf_dir, materialized=True)
    other = first.where(~F.col("district").endswith("1")) \
        .withColumn("total_children", F.when(F.col("district").endswith("2"), F.lit(-1)).otherwise(F.col("total_children")).cast("long"))
    named = lambda df, n: df.select(F.lit(n).alias("check"), "*")
    return named(Q.rebuild_match(first, district_cube(spark, sf_dir)), "rebuild").unionByName(named(Q.rebuild_match(first, other), "planted"))


_PLANTED_ORDERS = "CASE WHEN o_orderkey % 1000 = 7 THEN o_totalprice + 1 ELSE o_totalprice END"


@register("dq_tree_diff", f"""
WITH a AS (SELECT o_orderkey, o_custkey, o_totalprice FROM orders),
b AS (SELECT o_orderkey, o_custkey, {_PLANTED_ORDERS} AS o_totalprice FROM orders WHERE o_orderkey % 1000 <> 3
      UNION ALL SELECT * FROM a WHERE o_orderkey % 1000 = 5)
SELECT o_orderkey, o_custkey, o_totalprice, CAST(sum(x) AS BIGINT) AS n_a, CAST(sum(y) AS BIGINT) AS n_b
FROM (SELECT *, 1 AS x, 0 AS y FROM a UNION ALL SELECT *, 0, 1 FROM b) GROUP BY 1, 2, 3 HAVING sum(x) <> sum(y)""")
def q_dq_tree_diff(spark, sf_dir):
    """A copy of the orders with rows changed, lost and doubled: the hash tree
    names each of them."""
    a = A.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    b = a.where("o_orderkey % 1000 <> 3").withColumn("o_totalprice", F.expr(_PLANTED_ORDERS)).unionByName(a.where("o_orderkey % 1000 = 5"))
    return Q.tree_diff(a, b, ["o_orderkey"])[0]


def _tol_sql():
    _, names = G.cube_sql(CUBE_ORDER)
    num = [c for c in names if c != "district"]
    stored = ", ".join(f"{G.rnd(G.d(G.qi(c)), 1)} AS {G.qi('s_' + c)}" for c in num)
    fresh = ", ".join(f"{G.d(G.qi(c))} AS {G.qi('f_' + c)}" for c in num)
    j = (f"j AS (SELECT * FROM (SELECT district, true AS s_ok, {stored} FROM cube) s "
         f"FULL JOIN (SELECT district, true AS f_ok, {fresh} FROM cube) f USING (district)),\n"
         f"k AS (SELECT CAST(count(*) FILTER (WHERE s_ok IS NULL OR f_ok IS NULL) AS BIGINT) AS key_only FROM j)")
    parts = []
    for c in num:
        a, b = G.qi("s_" + c), G.qi("f_" + c)
        bad = (f"CASE WHEN {a} IS NULL AND {b} IS NULL THEN false WHEN {a} IS NULL OR {b} IS NULL THEN true "
               f"ELSE abs({a} - {b}) > 0.0::DOUBLE + 1e-6::DOUBLE * abs({b}) END")
        both = "s_ok AND f_ok"
        parts.append(f"SELECT '{c}' AS \"column\", CAST(count(*) FILTER (WHERE {both} AND {bad}) AS BIGINT) AS mismatches, "
                     f"{G.rnd(f'max(CASE WHEN {both} THEN abs({a} - {b}) END)', 9)} AS max_abs_diff FROM j")
    body = "\nUNION ALL\n".join(parts)
    return (G.with_clause(ALL_CTES) + ",\n" + j +
            f"\nSELECT u.*, k.key_only, u.mismatches = 0 AND k.key_only = 0 AS passed FROM ({body}) u, k")


@register("dq_tolerance_diff", _tol_sql())
def q_dq_tolerance_diff(spark, sf_dir):
    """Stored cube (numerics kept at 1 dp, as a coarse export would) vs a
    fresh build, rtol 1e-6: reports which columns drift and by how much."""
    fresh = district_cube(spark, sf_dir, materialized=True)
    num = [f.name for f in fresh.schema.fields if isinstance(f.dataType, T.NumericType)]
    stored = fresh
    stored = write_and_read(stored.withColumns({c: X.rnd(F.col(f"`{c}`").cast("double"), 1) for c in num}), "stored-cube")
    return Q.tolerance_diff(stored, fresh, ["district"], rtol=1e-6)


ROLLUP_COLS = (["total_children_0_5", "measured_children_0_5", "stunted_severe_n_0_5", "stunted_moderate_n_0_5",
                "stunted_normal_n_0_5", "sam_n", "mam_n", "underweight_severe_n_0_5", "underweight_moderate_n_0_5",
                "underweight_normal_n_0_5"])


@register("dq_rollup_reconcile", G.with_clause(G.base_ctes(["gm_0_5"])) + "\nSELECT *, coalesce(detail_sum = rollup_value, false) AS passed FROM (\n" +
          "\nUNION ALL\n".join(
              f"SELECT '{c}' AS \"column\", CAST(sum({c}) FILTER (WHERE lower(trim(district)) IS DISTINCT FROM 'total') AS BIGINT) AS detail_sum, "
              f"CAST(sum({c}) FILTER (WHERE lower(trim(district)) = 'total') AS BIGINT) AS rollup_value FROM src_gm_0_5"
              for c in ROLLUP_COLS) + ")")
def q_dq_rollup_reconcile(spark, sf_dir):
    return Q.rollup_reconcile(A.src_gm_0_5(spark, sf_dir), "district", ROLLUP_COLS)
