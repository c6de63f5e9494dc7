"""Queries: entity lookup, available keys, structured profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridcube.operators import serve as SV
from gridcube.plans import analogues as A
from gridcube.plans import sqlgen as G
from gridcube.plans.catalog import register
from gridcube.plans.q_cube import district_cube
from gridcube.plans.q_stats import WITH_LEGACY, legacy
from gridcube.sources.registry import CUBE_ORDER

qi = G.qi

# Requests are built from customer rows: a padded, re-cased nation name
# (exact), a fragment of it (contains), or a name no key contains.
_REQ = ("CASE WHEN c_acctbal > 5000 THEN '  ' || lower(n_name) || ' ' "
        "WHEN c_acctbal > 0 THEN upper(substr(n_name, 3)) "
        "ELSE 'atlantis ' || CAST(c_custkey AS VARCHAR) END")
_REQ_SPARK = _REQ.replace("AS VARCHAR", "AS STRING")


def requests(spark, sf_dir):
    c = A.table(spark, sf_dir, "customer")
    n = A.table(spark, sf_dir, "nation")
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        F.col("c_custkey").alias("request_id"), F.expr(_REQ_SPARK).alias("request"))


_LOOKUP_SQL = WITH_LEGACY + f""",
keys AS (SELECT DISTINCT District AS k, lower(trim(District)) AS nk FROM legacy WHERE District IS NOT NULL),
req AS (SELECT c_custkey AS request_id, {_REQ} AS request, lower(trim({_REQ})) AS q
        FROM customer JOIN nation ON c_nationkey = n_nationkey),
ex AS (SELECT request_id, min(k) AS m FROM req JOIN keys ON q = nk GROUP BY request_id),
pa AS (SELECT request_id, min(k) AS m FROM req JOIN keys ON contains(nk, q) GROUP BY request_id),
res AS (SELECT req.request_id, req.request, coalesce(ex.m, pa.m) AS "match",
               CASE WHEN ex.m IS NOT NULL THEN 'exact' WHEN pa.m IS NOT NULL THEN 'contains' ELSE 'not_found' END AS status
        FROM req LEFT JOIN ex ON req.request_id = ex.request_id LEFT JOIN pa ON req.request_id = pa.request_id)
"""


@register("lookup_exact", _LOOKUP_SQL + "SELECT * FROM res WHERE status = 'exact'")
def q_lookup_exact(spark, sf_dir):
    r = SV.lookup(requests(spark, sf_dir), "request_id", "request", legacy(spark, sf_dir))
    return r.where(F.col("status") == "exact")


@register("lookup_fallback", _LOOKUP_SQL + "SELECT * FROM res")
def q_lookup_fallback(spark, sf_dir):
    return SV.lookup(requests(spark, sf_dir), "request_id", "request", legacy(spark, sf_dir))


_HOT = {"a": "substr(c_name, 5, 9)", "b": "substr(c_name, length(c_name) - 3, 4)", "c": "substr(c_name, 12, 2)", "d": "concat('x', substr(c_name, 12, 5))"}


@register("lookup_hot_gram", "WITH req AS (" + " UNION ALL ".join(f"SELECT concat('{k}', c_custkey) AS request_id, {e} AS request FROM customer" for k, e in _HOT.items()) + """),
texts AS (SELECT DISTINCT lower(trim(request)) AS q FROM req),
found AS (SELECT q, min(CASE WHEN lower(trim(c_name)) = q THEN c_name END) AS exact, min(c_name) AS part FROM texts JOIN customer ON contains(lower(trim(c_name)), q) GROUP BY q)
SELECT request_id, request, coalesce(exact, part) AS "match", CASE WHEN exact IS NOT NULL THEN 'exact' WHEN part IS NOT NULL THEN 'contains' ELSE 'not_found' END AS status
FROM req LEFT JOIN found ON lower(trim(request)) = q""")
def q_lookup_hot_gram(spark, sf_dir):
    """Customer names all begin alike: texts cut from them share grams that
    every key has, are rare, are shorter than a gram, or are in no key."""
    c = A.table(spark, sf_dir, "customer")
    req = c.select(F.explode(F.array(*[F.struct(F.expr(f"concat('{k}', c_custkey)").alias("request_id"), F.expr(e).alias("request")) for k, e in _HOT.items()])).alias("r"))
    return SV.lookup(req.select("r.*"), "request_id", "request", c, key="c_name")


@register("available_keys", WITH_LEGACY + "\nSELECT DISTINCT District FROM legacy WHERE District IS NOT NULL")
def q_available_keys(spark, sf_dir):
    return SV.available_keys(legacy(spark, sf_dir))


_PROFILE_COLS = [("stunting_5_6", "stunting_pct", "Stunting_Total_%"), ("maternal_indicators", "pw_anaemia_rate", "PW_Anaemia_Rate"),
                 ("service_delivery", "active_awc_pct", "Active_AWC_%")]


@register("lookup_profile", _LOOKUP_SQL + f"""
SELECT request_id, request, "match", status, {", ".join(f"CASE WHEN isnan(legacy.{qi(c)}) THEN NULL ELSE legacy.{qi(c)} END AS {g}__{f}" for g, f, c in _PROFILE_COLS)},
       CASE WHEN cube.district IS NOT NULL THEN CAST({len(G.cube_sql(CUBE_ORDER)[1])} AS BIGINT) END AS raw_fields,
       cube.total_children AS raw_total_children, cube.total_pw_x AS raw_total_pw_x
FROM res LEFT JOIN legacy ON "match" = legacy.District LEFT JOIN cube ON cube.district = "match"
UNION ALL SELECT NULL, NULL, k, 'available', NULL, NULL, NULL, NULL, NULL, NULL FROM keys
WHERE EXISTS (SELECT 1 FROM res WHERE status = 'not_found')""")
def q_lookup_profile(spark, sf_dir):
    """A named request returns the structured profile and, as ``raw``, the full
    cube record; the available keys follow once if a request was not found."""
    cube = district_cube(spark, sf_dir, materialized=True)
    r = SV.lookup_records(requests(spark, sf_dir), "request_id", "request", SV.legacy_view(cube), full=cube)
    return r.select("request_id", "request", "match", "status", *[F.col(f"{g}.{f}").alias(f"{g}__{f}") for g, f, _ in _PROFILE_COLS],
                    F.when(F.col("raw").isNotNull(), F.size(F.json_object_keys("raw")).cast("long")).alias("raw_fields"),
                    F.get_json_object("raw", "$.total_children").cast("long").alias("raw_total_children"),
                    F.get_json_object("raw", "$.total_pw_x").cast("long").alias("raw_total_pw_x"))


_PROFILE_FIELDS = [
    ("stunting_5_6", "stunting_pct", "Stunting_Total_%"), ("stunting_5_6", "underweight_pct", "Underweight_Total_%"),
    ("stunting_5_6", "measurement_efficiency", "Measurement_Efficiency"),
    ("stunting_0_5", "stunting_pct", "Stunting_Total_Pct_0_5"), ("stunting_0_5", "underweight_pct", "Underweight_Total_Pct_0_5"),
    ("stunting_0_5", "measurement_coverage", "Measurement_Coverage_Pct_0_5"),
    ("maternal_indicators", "pw_anaemia_rate", "PW_Anaemia_Rate"),
    ("maternal_indicators", "optimum_weight_gain", "Optimum_WG_Latest_%"),
    ("service_delivery", "home_visit_pct", "HV_Percentage"), ("service_delivery", "active_awc_pct", "Active_AWC_%"),
]


@register("structured_profile", WITH_LEGACY + "\nSELECT District AS district, " + ", ".join(
    f"CASE WHEN isnan({qi(src)}) THEN NULL ELSE {qi(src)} END AS {g}__{f}" for g, f, src in _PROFILE_FIELDS) +
    " FROM legacy")
def q_structured_profile(spark, sf_dir):
    """Nested profile per key; flattened here (group__field) so engines
    compare plain columns. The library function also returns ``raw`` JSON."""
    p = SV.structured_profile(legacy(spark, sf_dir), with_raw=False)
    return p.select("district", *[F.col(f"{g}.{f}").alias(f"{g}__{f}") for g, f, _ in _PROFILE_FIELDS])
