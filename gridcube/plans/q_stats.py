"""Queries: legacy view, top/bottom-n, correlations, BI and chart data."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from gridcube.operators import serve as SV
from gridcube.operators import stats as ST
from gridcube.plans import analogues as A
from gridcube.plans import sqlgen as G
from gridcube.plans.catalog import register
from gridcube.plans.q_cube import district_cube
from gridcube.session import scratch_path
from gridcube.sources import files as FS
from gridcube.sources.registry import CUBE_ORDER

qi, pct, rnd, d = G.qi, G.pct, G.rnd, G.d


def _legacy_sql_cols() -> list[tuple[str, str]]:
    z = lambda a, b: f"coalesce({pct(a, b)}, 0.0::DOUBLE)"
    aww = f"{rnd(f'{d(qi('aww_completed_80pct_me'))} / NULLIF((SELECT sum({d(qi('aww_completed_80pct_me'))}) FROM cube), 0) * 100::DOUBLE')}"
    cols = [
        ("District", "district"), ("Stunting_Total_%", "stunting_total_pct"),
        ("Underweight_Total_%", "underweight_total_pct"), ("Measurement_Efficiency", "measurement_efficiency"),
        ("Measurement_Coverage_%", "measurement_coverage_pct_x"),
        ("Stunting_Total_Pct_0_5", "stunting_total_pct_0_5"), ("Underweight_Total_Pct_0_5", "underweight_total_pct_0_5"),
        ("Measurement_Coverage_Pct_0_5", "measurement_coverage_pct_0_5"),
        ("LBW_Rate_%", pct("lbw_children_0_6m", "total_children_0_6m")),
        ("PW_Anaemia_Rate", z("anaemic_pw", "hb_measured_pw")),
        ("LM_Anaemia_Rate", z("anaemic_lm", "hb_measured_lm")),
        ("Child_Anaemia_Rate", z("anaemic_child", "hb_measured_child")),
    ]
    cols += [(f"ANC{k}_Completion_%", pct(f"pw_completed_anc{k}", f"pw_due_anc{k}")) for k in (1, 2, 3, 4)]
    cols += [
        ("Optimum_WG_Latest_%", pct("pw_optimum_latest", "total_pw_x")),
        ("PW_Hb_Measured_%", pct("pw_hb_measured", "total_pw_x")),
        ("PW_Anaemia_Rate_Latest_%", pct("pw_anaemic_latest", "pw_hb_measured")),
        ("AG_Measured_%", pct("ag_measured", "total_ag_x")),
        ("AG_Hb_Measured_%", pct("ag_hb_measured", "total_ag_x")),
        ("AG_Severely_Thin_%", pct("ag_severely_thin", "ag_measured")),
        ("AG_Thin_%", pct("ag_thin", "ag_measured")),
        ("AG_Normal_%", pct("ag_normal", "ag_measured")),
        ("AG_Overweight_%", pct("ag_overweight", "ag_measured")),
        ("AG_Obese_%", pct("ag_obese", "ag_measured")),
        ("AG_Anaemia_%", pct("ag_anaemic", "ag_hb_measured")),
        ("AWW_80pct_ME_%", aww),
        ("HV_Percentage", "visit_coverage_pct"),
        ("AWW_60pct_HV_%", pct("aww_60pct_hv", "total_aww")),
        ("SAM_Rate_%", pct("sam_total", "total_beneficiary")),
        ("SUW_Rate_%", pct("suw_total", "total_beneficiary")),
        ("AG_%", pct("total_ag_y", "total_beneficiary")),
        ("Total_SAM", "sam_total"), ("Total_SUW", "suw_total"),
        ("Active_AWC_%", pct("active_awc", "total_awc")),
        ("Inactive_AWC_%", pct("inactive_awc", "total_awc")),
    ]
    return cols


CUBE_CTES = G.cube_ctes(CUBE_ORDER)
LEGACY_CTES = CUBE_CTES + [("legacy", "SELECT " + ", ".join(f"{e} AS {qi(n)}" for n, e in _legacy_sql_cols())
                            + " FROM cube")]
WITH_LEGACY = G.with_clause(LEGACY_CTES)


def legacy(spark, sf_dir, materialized: bool = False):
    """The legacy view over a fresh cube; ``materialized`` writes the
    (entity-grain) result once when several branches consume it."""
    from gridcube.plans.q_cube import materialize
    v = SV.legacy_view(district_cube(spark, sf_dir))
    return materialize(v) if materialized else v


def _legacy_full_sql():
    derived = dict(_legacy_sql_cols())
    # names that are a cube column in lower case need no entry; the rest is listed as fixed values
    cols = [f"{derived.get(n) or qi(SV.LEGACY_SOURCE.get(n) or n.lower().replace(' ', '_').replace('-', '_'))} AS {qi(n)}" for n in SV.LEGACY_NAMES]
    return G.with_clause(CUBE_CTES) + "\nSELECT " + ", ".join(cols) + " FROM cube"


@register("legacy_full_view", _legacy_full_sql())
def q_legacy_full_view(spark, sf_dir):
    return SV.legacy_full(district_cube(spark, sf_dir))


@register("cube_published_names", G.with_clause(CUBE_CTES) + "\nSELECT " + ", ".join(
    f"{qi(c)} AS {qi(SV.PUBLISHED_NAMES.get(c, c))}" for c in G.cube_sql(CUBE_ORDER)[1]) + " FROM cube")
def q_cube_published_names(spark, sf_dir):
    return SV.published_names(district_cube(spark, sf_dir))


@register("bi_export", WITH_LEGACY + "\nSELECT " + ", ".join(qi(c) for c in SV.LEGACY_BI_COLUMNS) + " FROM legacy")
def q_bi_export(spark, sf_dir):
    """The BI subset written as CSV files with headers and read back."""
    view = SV.bi_subset(legacy(spark, sf_dir))
    path = scratch_path(spark, f"bi-{uuid.uuid4().hex[:12]}")
    FS.write_table(view, path, None, fmt="csv")
    return spark.read.schema(view.schema).option("header", True).option("enforceSchema", False).csv(path)


@register("legacy_view", WITH_LEGACY + "\nSELECT * FROM legacy")
def q_legacy_view(spark, sf_dir):
    return legacy(spark, sf_dir)


# ------------------------------------------------------------------ top-k

@register("top_n", "SELECT c_custkey, c_acctbal, CAST(row_number() OVER (ORDER BY c_acctbal DESC NULLS LAST, "
                   "c_custkey) AS BIGINT) AS rank FROM customer QUALIFY rank <= 10")
def q_top_n(spark, sf_dir):
    c = A.table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return ST.top_n(c, "c_acctbal", 10, ["c_custkey"])


@register("bottom_n", "SELECT c_custkey, c_acctbal, CAST(row_number() OVER (ORDER BY c_acctbal ASC NULLS LAST, "
                      "c_custkey) AS BIGINT) AS rank FROM customer QUALIFY rank <= 10")
def q_bottom_n(spark, sf_dir):
    c = A.table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return ST.bottom_n(c, "c_acctbal", 10, ["c_custkey"])


def _tb_sql(metrics, n=5):
    parts = []
    for m in metrics:
        for side, o in (("top", "DESC"), ("bottom", "ASC")):
            parts.append(
                f"SELECT * FROM (SELECT '{m}' AS metric, '{side}' AS side, CAST(row_number() OVER "
                f"(ORDER BY {qi(m)} {o}, District) AS BIGINT) AS rank, District, CAST({qi(m)} AS DOUBLE) AS value "
                f"FROM legacy WHERE District IS NOT NULL AND {qi(m)} IS NOT NULL AND NOT isnan({qi(m)})) WHERE rank <= {n}")
    return "\nUNION ALL\n".join(parts)


@register("top_bottom_report", WITH_LEGACY + "\n" + _tb_sql(SV.TOP_BOTTOM_METRICS))
def q_top_bottom_report(spark, sf_dir):
    return ST.top_bottom_report(legacy(spark, sf_dir, True), "District", SV.TOP_BOTTOM_METRICS + ["Not_A_Column"], 5)


# ------------------------------------------------------------ correlation

def _corr_sql(src, cols, full=False, digits=6, where=""):
    parts = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if not full and j <= i:
                continue
            parts.append(f"SELECT '{a}' AS indicator_a, '{b}' AS indicator_b, CAST({i} AS BIGINT) AS pos_a, "
                         f"CAST({j} AS BIGINT) AS pos_b, {rnd(G.corr(qi(a), qi(b)), digits)} AS correlation, "
                         f"CAST(count(*) FILTER (WHERE {qi(a)} IS NOT NULL AND {qi(b)} IS NOT NULL) AS BIGINT) AS n_rows "
                         f"FROM {src} {where}")
    return "\nUNION ALL\n".join(parts)


def _listwise_where(cols):
    return "WHERE " + " AND ".join(f"{qi(c)} IS NOT NULL AND NOT isnan({qi(c)})" for c in cols)


@register("corr_pairs_listwise", WITH_LEGACY + "\n" +
          _corr_sql("legacy", SV.CORRELATE_COLUMNS, where=_listwise_where(SV.CORRELATE_COLUMNS)))
def q_corr_pairs_listwise(spark, sf_dir):
    return ST.corr_pairs_listwise(legacy(spark, sf_dir, True), SV.CORRELATE_COLUMNS)


@register("corr_strongest", WITH_LEGACY + ",\npairs AS (\n" +
          _corr_sql("legacy", SV.CORRELATE_COLUMNS, where=_listwise_where(SV.CORRELATE_COLUMNS)) + ")\n" +
          "SELECT * FROM (SELECT CAST(row_number() OVER (ORDER BY abs(correlation) DESC NULLS LAST, pos_a, pos_b) AS BIGINT) AS rank, "
          "indicator_a, indicator_b, correlation, " + rnd("correlation", 3) + " AS correlation_3dp, "
          "CASE WHEN correlation > 0 THEN 'positive' ELSE 'negative' END AS direction "
          "FROM pairs) WHERE rank <= 10")
def q_corr_strongest(spark, sf_dir):
    return ST.corr_strongest(ST.corr_pairs_listwise(legacy(spark, sf_dir, True), SV.CORRELATE_COLUMNS), 10)


DOC_COLS = ["n_chars", "n_lines", "quality", "toxic_en"]
DOC_SQL = ("(SELECT d.n_chars, len(string_split(d.text, chr(10))) - 1 AS n_lines, l.quality, "
           "CASE WHEN d.lang = 'en' THEN l.toxic END AS toxic_en "
           "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id) dl")


def doc_features(spark, sf_dir):
    """Documents with their labels; whole texts are scanned for line counts.
    Labels cover only some documents, toxicity only English ones, so each
    pair sees a different set of rows (pairwise deletion)."""
    # lines are counted before the join, so no text is shuffled
    d = A.table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang", (F.size(F.split("text", "\n")) - 1).alias("n_lines"))
    j = d.join(A.table(spark, sf_dir, "labels"), "doc_id", "left")
    return j.select("n_chars", "n_lines", "quality", F.when(F.col("lang") == "en", F.col("toxic")).alias("toxic_en"))


@register("corr_matrix_pairwise", _corr_sql(DOC_SQL, DOC_COLS, full=True))
def q_corr_matrix_pairwise(spark, sf_dir):
    return ST.corr_matrix_pairwise(doc_features(spark, sf_dir), DOC_COLS + ["not_a_column"])


@register("corr_matrix_rounded", WITH_LEGACY + "\n" + _corr_sql("legacy", SV.HEATMAP_COLUMNS, full=True, digits=3))
def q_corr_matrix_rounded(spark, sf_dir):
    return ST.corr_matrix_rounded(legacy(spark, sf_dir, True), SV.HEATMAP_COLUMNS)


# Every numeric column of the cube with every other, which is what the one-scan form is for.
_CUBE_NUMBERS = [c for c in G.cube_sql(CUBE_ORDER)[1] if c != "district"]
_ZERO = "+ 0.0::DOUBLE"          # no negative zeros


@register("corr_matrix_cube", G.with_clause(CUBE_CTES) + f""",
w AS (SELECT district, {", ".join(f"CAST({qi(c)} AS DOUBLE) AS {qi(c)}" for c in _CUBE_NUMBERS)} FROM cube),
u AS (SELECT district, name, v FROM (UNPIVOT w ON COLUMNS(* EXCLUDE (district)) INTO NAME name VALUE v) WHERE NOT isnan(v)),
names(pos, name) AS (VALUES {", ".join(f"({i}::BIGINT, '{c}')" for i, c in enumerate(_CUBE_NUMBERS))}),
cells AS (SELECT x.name AS a, y.name AS b, {rnd(G.corr("x.v", "y.v"), 6)} {_ZERO} AS r, CAST(count(*) AS BIGINT) AS n
          FROM u x JOIN u y USING (district) GROUP BY 1, 2)
SELECT p.name AS indicator_a, q.name AS indicator_b, p.pos AS pos_a, q.pos AS pos_b, r AS correlation, coalesce(n, 0) AS n_rows
FROM names p CROSS JOIN names q LEFT JOIN cells ON p.name = a AND q.name = b""")
def q_corr_matrix_cube(spark, sf_dir):
    cube = district_cube(spark, sf_dir)
    return ST.corr_matrix_pairwise(cube, _CUBE_NUMBERS).withColumn("correlation", F.col("correlation") + F.lit(0.0))


RANK_COLS = ["l_quantity", "l_discount", "l_tax"]


def _spearman_sql(cols):
    parts = []
    for i, a in enumerate(cols):
        for b in cols[i + 1:]:
            parts.append(
                f"SELECT '{a}' AS indicator_a, '{b}' AS indicator_b, {rnd(G.corr('ra', 'rb'), 6)} AS correlation, "
                f"CAST(count(*) AS BIGINT) AS n_rows FROM (SELECT "
                f"rank() OVER (ORDER BY {a}) + (count(*) OVER (PARTITION BY {a}) - 1) / 2.0 AS ra, "
                f"rank() OVER (ORDER BY {b}) + (count(*) OVER (PARTITION BY {b}) - 1) / 2.0 AS rb "
                f"FROM lineitem WHERE {a} IS NOT NULL AND {b} IS NOT NULL)")
    return "\nUNION ALL\n".join(parts)


@register("corr_spearman", _spearman_sql(RANK_COLS))
def q_corr_spearman(spark, sf_dir):
    return ST.corr_spearman(A.table(spark, sf_dir, "lineitem"), RANK_COLS)


def _kendall_sql(cols):
    parts = []
    for i, a in enumerate(cols):
        for b in cols[i + 1:]:
            cells = f"(SELECT {a} AS x, {b} AS y, count(*) AS c FROM lineitem WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY 1, 2)"
            parts.append(f"""SELECT '{a}' AS indicator_a, '{b}' AS indicator_b,
  {rnd("s / sqrt((n0 - n1) * (n0 - n2))", 6)} AS correlation, CAST(coalesce(n, 0) AS BIGINT) AS n_rows
FROM (SELECT
  (SELECT sum(sign(p.x - q.x) * sign(p.y - q.y) * p.c * q.c) / 2 FROM {cells} p, {cells} q)::DOUBLE AS s,
  (SELECT sum(c) FROM {cells})::DOUBLE AS n,
  (SELECT sum(c) * (sum(c) - 1) / 2 FROM {cells})::DOUBLE AS n0,
  (SELECT sum(t * (t - 1) / 2) FROM (SELECT sum(c) AS t FROM {cells} GROUP BY x))::DOUBLE AS n1,
  (SELECT sum(t * (t - 1) / 2) FROM (SELECT sum(c) AS t FROM {cells} GROUP BY y))::DOUBLE AS n2)""")
    return "\nUNION ALL\n".join(parts)


@register("corr_kendall", _kendall_sql(RANK_COLS))
def q_corr_kendall(spark, sf_dir):
    return ST.corr_kendall(A.table(spark, sf_dir, "lineitem"), RANK_COLS)


@register("corr_kendall_distinct", f"""
SELECT 'o_totalprice' AS indicator_a, 'o_custkey' AS indicator_b, {rnd("s / sqrt((n0 - n1) * (n0 - n2))", 6)} AS correlation, CAST(n AS BIGINT) AS n_rows
FROM (SELECT (SELECT sum(sign(p.o_totalprice - q.o_totalprice) * sign(p.o_custkey - q.o_custkey)) / 2 FROM orders p, orders q)::DOUBLE AS s,
  (SELECT count(*) FROM orders)::DOUBLE AS n, (SELECT count(*) * (count(*) - 1) / 2 FROM orders)::DOUBLE AS n0,
  (SELECT sum(t * (t - 1) / 2) FROM (SELECT count(*) AS t FROM orders GROUP BY o_totalprice))::DOUBLE AS n1,
  (SELECT sum(t * (t - 1) / 2) FROM (SELECT count(*) AS t FROM orders GROUP BY o_custkey))::DOUBLE AS n2)""")
def q_corr_kendall_distinct(spark, sf_dir):
    """Nearly every row is a cell of its own, so the merge tree grows with the table."""
    return ST.corr_kendall(A.table(spark, sf_dir, "orders").select("o_totalprice", "o_custkey"), ["o_totalprice", "o_custkey"])


# --------------------------------------------------------------- BI/chart

@register("bi_subset", WITH_LEGACY + "\nSELECT " + ", ".join(qi(c) for c in SV.LEGACY_BI_COLUMNS) + " FROM legacy")
def q_bi_subset(spark, sf_dir):
    return SV.bi_subset(legacy(spark, sf_dir), SV.LEGACY_BI_COLUMNS + ["Not_In_Cube_%"])


@register("scatter_points", WITH_LEGACY + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{y} vs {x}' AS pair, District, CAST({qi(x)} AS DOUBLE) AS x, CAST({qi(y)} AS DOUBLE) AS y FROM legacy "
    f"WHERE District IS NOT NULL AND {qi(x)} IS NOT NULL AND NOT isnan({qi(x)}) AND {qi(y)} IS NOT NULL AND NOT isnan({qi(y)})"
    for x, y in SV.SCATTER_PAIRS))
def q_scatter_points(spark, sf_dir):
    return SV.scatter_points(legacy(spark, sf_dir, True))
