"""Per-source indicator functions (M1-M10) at the entity grain.

Each takes a source table with canonical column names (see
``sources.registry``) and returns it with its derived columns appended and
the key cleaned. Each is a single projection (``derive``), compiled into one
codegen stage after the scan; dependent expressions are inlined and shared by
subexpression elimination. The share of a grand total adds a scalar subquery.

Units follow the monthly exports: ``*_pct`` from the growth sources are
0-100 percentages, most others are 0-1 ratios despite the suffix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcube.functions import exprs as X
from gridcube.functions.headers import require_columns
from gridcube.operators.clean import drop_rollup


def derive(df: DataFrame, cols: dict, key: str | None = "district") -> DataFrame:
    """One projection: clean the key in place, replace existing columns in
    place and append new ones in order (``withColumns`` semantics) -- a
    single analysis pass and a single codegen'd projection."""
    if key is not None and key not in df.columns:
        raise KeyError(f"table has no '{key}' column after cleaning")
    out = []
    for c in df.columns:
        if c in cols:
            out.append(cols[c].alias(c))
        elif c == key:
            out.append(X.clean_key(F.col(f"`{c}`")).alias(c))
        else:
            out.append(F.col(f"`{c}`"))
    out += [e.alias(n) for n, e in cols.items() if n not in df.columns]
    return df.select(*out)


def to_entity_grain(df: DataFrame, keys: list[str], counts: list[str] | None = None) -> DataFrame:
    """Sources that arrive below the entity grain (per centre, per
    beneficiary) are summed to it before any indicator is formed: ratios are
    ratios of sums, never means of ratios. Only count columns are kept
    (integral columns by default); given percentages are dropped so they are
    recomputed from the summed counts. A partial aggregate runs map-side, so
    a hot entity collapses before the shuffle."""
    from pyspark.sql import types as T
    if counts is None:
        counts = [f.name for f in df.schema.fields
                  if isinstance(f.dataType, (T.LongType, T.IntegerType, T.ShortType)) and f.name not in keys]
    return df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(
        *[F.sum(F.col(f"`{c}`")).cast("long").alias(c) for c in counts])


def _growth_cols(sfx: str = "") -> dict:
    c = lambda name: F.col(name + sfx)
    stunting = X.sum_of_parts(c("stunted_severe_pct"), c("stunted_moderate_pct"), n=2)
    underweight = X.sum_of_parts(c("underweight_severe_pct"), c("underweight_moderate_pct"), n=2)
    return {
        "stunting_total_pct" + sfx: stunting,
        "underweight_total_pct" + sfx: underweight,
        "measurement_coverage_pct" + sfx: X.pct(c("measured_children"), c("total_children")),
        "normal_stunting_ratio" + sfx: X.ratio_inf_to_zero(c("stunted_normal_pct"), stunting),
        "normal_underweight_ratio" + sfx: X.ratio_inf_to_zero(c("underweight_normal_pct"), underweight),
    }


def growth_base(df: DataFrame, key: str = "district") -> DataFrame:
    """M1: stunting / underweight totals, coverage %, normal-to-total ratios."""
    return derive(df, _growth_cols(), key)


def growth_rollup(df: DataFrame, key: str = "district") -> DataFrame:
    """M2: as M1 on the 0-5 band (``_0_5`` suffix), after dropping the
    ``Total`` rollup row."""
    return derive(drop_rollup(df, key), _growth_cols("_0_5"), key)


def anaemia(df: DataFrame, key: str = "district") -> DataFrame:
    """M3: anaemic / haemoglobin-measured per cohort; 0 when none measured."""
    return derive(df, {
        "pw_anaemia_rate": X.safe_ratio("anaemic_pw", "hb_measured_pw"),
        "lm_anaemia_rate": X.safe_ratio("anaemic_lm", "hb_measured_lm"),
        "child_anaemia_rate": X.safe_ratio("anaemic_child", "hb_measured_child"),
    }, key)


def low_rate(df: DataFrame, key: str = "district",
             num: str = "lbw_children_0_6m", den: str = "total_children_0_6m",
             out: str = "lbw_rate_pct") -> DataFrame:
    """M4: a single zero-safe ratio (a 0-1 ratio despite the name)."""
    require_columns(df.columns, [num, den], "low-rate source")
    return derive(df, {out: X.safe_ratio(num, den)}, key)


def funnel(df: DataFrame, key: str = "district") -> DataFrame:
    """M5: ANC completion per visit, optimum weight gain, Hb measured and
    anaemia at the latest visit."""
    cols = {f"anc{k}_completion_pct": X.safe_ratio(f"pw_completed_anc{k}", f"pw_due_anc{k}")
            for k in (1, 2, 3, 4)}
    cols.update({
        "optimum_wg_latest_pct": X.safe_ratio("pw_optimum_latest", "total_pw"),
        "pw_hb_measured_pct": X.safe_ratio("pw_hb_measured", "total_pw"),
        "pw_anaemia_latest_pct": X.safe_ratio("pw_anaemic_latest", "pw_hb_measured"),
    })
    return derive(df, cols, key)


def partial_coverage(df: DataFrame, key: str = "district") -> DataFrame:
    """M6: adolescent-girl indicators. ``ag_measured_pct`` is parsed when the
    source carries it, otherwise derived as a ratio (schema-time branch)."""
    if "ag_measured_pct" in df.columns:
        measured = X.lenient_num("ag_measured_pct")
    else:
        measured = X.safe_ratio("ag_measured", "total_ag")
    underweight = X.sum_of_parts("ag_severely_thin", "ag_thin", null_as_zero=True)
    return derive(df, {
        "ag_measured_pct": measured,
        "ag_underweight": underweight,
        "ag_underweight_pct": X.safe_ratio(underweight, "total_ag"),
        "ag_anaemia_rate": X.safe_ratio("ag_anaemic", "ag_hb_measured"),
    }, key)


def share_of_total_col(df: DataFrame, column: str, n: int = 2):
    """P8 as a Column: ``x / sum(x)`` over the whole table, 0 when the total
    is 0. The total is a scalar subquery: computed once by a partial/final
    aggregate and inlined, so there is no cross join and no window over a
    single partition."""
    total = df.agg(F.sum(F.col(column).cast("double"))).scalar()
    return F.coalesce(X.rnd(F.try_divide(F.col(column).cast("double"), total), n), F.lit(0.0))


def share_of_total(df: DataFrame, column: str, out: str, n: int = 2) -> DataFrame:
    return df.withColumn(out, share_of_total_col(df, column, n))


def share_within(df: DataFrame, column: str, out: str, by: list[str], n: int = 2) -> DataFrame:
    """P8 per group (e.g. per month): the group totals are one small
    aggregate joined back on the group key (one row per group, so the
    planner broadcasts it after checking its size)."""
    tot = df.groupBy(*by).agg(F.sum(F.col(column).cast("double")).alias("__tot"))
    j = df.join(tot, by, "left")
    r = F.coalesce(X.rnd(F.try_divide(F.col(column).cast("double"), F.col("__tot")), n), F.lit(0.0))
    return j.withColumn(out, r).drop("__tot")


def share(df: DataFrame, key: str = "district") -> DataFrame:
    """M7: measured / total (0-1) and each entity's share of the grand total
    of workers who completed 80% of measurements. A table with a ``month``
    column gets shares of each month's total."""
    if "month" in df.columns:
        df = share_within(df, "aww_completed_80pct_me", "aww_80pct_me_share", ["month"])
        return derive(df, {"measurement_coverage_pct": X.safe_ratio("children_measured", "children_total"),
                           "aww_80pct_me_share": F.col("aww_80pct_me_share")}, key)
    return derive(df, {
        "measurement_coverage_pct": X.safe_ratio("children_measured", "children_total"),
        "aww_80pct_me_share": share_of_total_col(df, "aww_completed_80pct_me"),
    }, key)


def visits(df: DataFrame, key: str = "district") -> DataFrame:
    """M8: visit coverage parsed leniently; workers reaching 60% of visits
    over all workers (not clamped: can exceed 1)."""
    return derive(df, {
        "visit_coverage_pct": X.lenient_num("visit_coverage_pct"),
        "aww_60pct_hv_pct": X.safe_ratio("aww_60pct_hv", "total_aww"),
    }, key)


def composition(df: DataFrame, key: str = "district") -> DataFrame:
    """M9: band totals, risk ratios over children (3 dp) and beneficiary
    shares (2 dp)."""
    children = X.sum_of_parts("children_6m_3y", "children_3y_5y", "children_5y_6y")
    sam = X.sum_of_parts("sam_6m_3y", "sam_3y_5y")
    suw = X.sum_of_parts("suw_6m_3y", "suw_3y_6y")
    both = X.sum_of_parts("sam_suw_6m_3y", "sam_suw_3y_5y")
    return derive(df, {
        "children_total": children, "sam_total": sam, "suw_total": suw, "sam_suw_total": both,
        "sam_ratio": X.safe_ratio(sam, children, 3),
        "suw_ratio": X.safe_ratio(suw, children, 3),
        "sam_suw_ratio": X.safe_ratio(both, children, 3),
        "pw_share_pct": X.safe_ratio("total_pw", "total_beneficiary"),
        "lm_share_pct": X.safe_ratio("total_lm", "total_beneficiary"),
        "ag_share_pct": X.safe_ratio("total_ag", "total_beneficiary"),
        "children_share_pct": X.safe_ratio(children, "total_beneficiary"),
    }, key)


def readiness(df: DataFrame, key: str = "district") -> DataFrame:
    """Active / inactive shares, churn (3 dp) and a weighted readiness
    score computed from the already-rounded shares (rounding order kept)."""
    active = X.safe_ratio("active_awc", "total_awc")
    inactive = X.safe_ratio("inactive_awc", "total_awc")
    return derive(df, {
        "active_awc_pct": active,
        "inactive_awc_pct": inactive,
        "awc_churn_rate": X.safe_ratio(F.col("new_awc_month") + F.col("inactive_awc_month"), "total_awc", 3),
        "awc_readiness_score": X.weighted_score(active, inactive),
    }, key)


# Source name -> indicator function, in cube order.
INDICATORS = {
    "gm_5_6": growth_base,
    "gm_0_5": growth_rollup,
    "anaemia": anaemia,
    "lbw": low_rate,
    "gwg": funnel,
    "ag": partial_coverage,
    "me": share,
    "hv": visits,
    "snp": composition,
    "awc": readiness,
}
