"""Queries: indicator sources, joins and the entity cube."""

from __future__ import annotations

from gridcube.operators import cube as C
from gridcube.operators import indicators as I
from gridcube.operators.clean import drop_rollup
from gridcube.plans import analogues as A
from gridcube.plans import sqlgen as G
from gridcube.plans.catalog import register
from gridcube.session import materialize as write_and_read
from gridcube.sources.registry import CUBE_ORDER

KEYS = ["district"]


def materialize(df):
    """Write an entity-grain intermediate once to the shared checkpoint
    folder (``spark.checkpoint.dir``) and read it from there: lineage is cut,
    and several consumers do not recompute it."""
    return write_and_read(df, "cube")


def indicator_frame(spark, sf_dir, source: str, facts=None):
    return I.INDICATORS[source](A.SOURCE_BUILDERS[source](spark, sf_dir, facts))


def indicator_frames(spark, sf_dir, order=CUBE_ORDER, facts=None):
    facts = facts if facts is not None else A.Facts.for_sources(spark, sf_dir, order)
    return {s: indicator_frame(spark, sf_dir, s, facts) for s in order}


def district_cube(spark, sf_dir, order=CUBE_ORDER, facts=None, materialized=False):
    """The cube. Each fact table is aggregated once (``Facts``), the
    ten entity-grain sources are derived from those aggregates, and the
    left-join fold runs over entity-grain tables only."""
    cube = C.build_cube(indicator_frames(spark, sf_dir, order, facts), list(order), KEYS)
    return materialize(cube) if materialized else cube


def _ind_sql(source: str) -> str:
    ctes = G.base_ctes([source])
    body, names = G.indicator_ctes(source)
    ctes += body
    return G.with_clause(ctes) + f"\nSELECT * FROM ind_{source}"


IND_KEYS = {
    "gm_5_6": "ind_growth_base", "gm_0_5": "ind_growth_rollup", "anaemia": "ind_anaemia",
    "lbw": "ind_low_rate", "gwg": "ind_funnel", "ag": "ind_partial_coverage", "me": "ind_share",
    "hv": "ind_visits", "snp": "ind_composition", "awc": "ind_readiness",
}

for _src, _key in IND_KEYS.items():
    register(_key, _ind_sql(_src))(lambda spark, sf_dir, _s=_src: indicator_frame(spark, sf_dir, _s))


@register("ind_partial_coverage_derived", G.with_clause(G.base_ctes(["ag"]) + G.indicator_ctes("ag")[0]) + f"""
SELECT i.* REPLACE ({G.safe_ratio("i.ag_measured", "i.total_ag")} AS ag_measured_pct) FROM ind_ag i""")
def q_partial_coverage_derived(spark, sf_dir):
    """M6 where the export gives no percentage: it is formed from the counts."""
    ind = I.partial_coverage(A.src_ag(spark, sf_dir).drop("ag_measured_pct"))
    return ind.select("district", "total_ag", "ag_measured", "ag_measured_pct",
                      *[c for c in ind.columns if c not in ("district", "total_ag", "ag_measured", "ag_measured_pct")])


@register("drop_rollup", G.with_clause(G.base_ctes(["gm_0_5"])) +
          "\nSELECT * FROM src_gm_0_5 WHERE lower(trim(district)) IS DISTINCT FROM 'total'")
def q_drop_rollup(spark, sf_dir):
    return drop_rollup(A.src_gm_0_5(spark, sf_dir), "district")


def _fold_sql(order):
    return G.with_clause(G.cube_ctes(order)) + "\nSELECT * FROM cube"


@register("left_join_key", _fold_sql(["gm_5_6", "lbw"]))
def q_left_join_key(spark, sf_dir):
    return district_cube(spark, sf_dir, ["gm_5_6", "lbw"])


@register("cube_collisions", _fold_sql(["gm_5_6", "gwg", "ag", "me", "snp"]))
def q_cube_collisions(spark, sf_dir):
    return district_cube(spark, sf_dir, ["gm_5_6", "gwg", "ag", "me", "snp"])


@register("district_cube", _fold_sql(CUBE_ORDER))
def q_district_cube(spark, sf_dir):
    return district_cube(spark, sf_dir)
