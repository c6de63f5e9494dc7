"""Consumer-facing views: legacy cube vocabulary, BI extracts, chart data,
entity lookup and structured profiles.

Lookups are batch joins of a request table against the cube (a request
stream works the same way), never per-request driver loops.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcube.functions import exprs as X
from gridcube.operators.clean import listwise_drop
from gridcube.session import materialize


def _c(name: str):
    return F.col(f"`{name}`")


def pick(df: DataFrame, name: str, side: str = "x") -> F.Column:
    """A cube column by its source name, following ``_x``/``_y`` suffixing."""
    if f"{name}_{side}" in df.columns:
        return _c(f"{name}_{side}")
    if name in df.columns:
        return _c(name)
    raise KeyError(f"cube has no column {name!r}")


def pct100(num, den, zero_fill: bool = False) -> F.Column:
    r = X.pct(num, den)
    return F.coalesce(r, F.lit(0.0)) if zero_fill else r


# The legacy (TitleCase / percent) column names consumers use.
LEGACY_BI_COLUMNS = [
    "District", "Stunting_Total_%", "Underweight_Total_%", "Measurement_Efficiency", "Measurement_Coverage_%",
    "Stunting_Total_Pct_0_5", "Underweight_Total_Pct_0_5", "Measurement_Coverage_Pct_0_5",
    "LBW_Rate_%", "PW_Anaemia_Rate", "AG_Anaemia_%", "Optimum_WG_Latest_%",
    "HV_Percentage", "Active_AWC_%", "SAM_Rate_%", "SUW_Rate_%",
]
CORRELATE_COLUMNS = [
    "Stunting_Total_%", "Underweight_Total_%", "Measurement_Efficiency", "Stunting_Total_Pct_0_5",
    "Underweight_Total_Pct_0_5", "Measurement_Coverage_Pct_0_5", "LBW_Rate_%", "PW_Anaemia_Rate",
    "AG_Anaemia_%", "HV_Percentage", "Optimum_WG_Latest_%",
]
HEATMAP_COLUMNS = [
    "Stunting_Total_%", "Underweight_Total_%", "Measurement_Efficiency", "Measurement_Coverage_%",
    "Stunting_Total_Pct_0_5", "Underweight_Total_Pct_0_5", "Measurement_Coverage_Pct_0_5",
    "LBW_Rate_%", "PW_Anaemia_Rate", "AG_Anaemia_%", "Optimum_WG_Latest_%", "HV_Percentage", "Active_AWC_%",
]
TOP_BOTTOM_METRICS = ["Stunting_Total_%", "Stunting_Total_Pct_0_5", "Underweight_Total_%", "Underweight_Total_Pct_0_5"]
SCATTER_PAIRS = [
    ("Measurement_Efficiency", "Stunting_Total_%"),
    ("Measurement_Coverage_Pct_0_5", "Stunting_Total_Pct_0_5"),
    ("PW_Anaemia_Rate", "LBW_Rate_%"),
]


# All columns of the legacy cube in order; the cube column of each name that is not
# the name itself in lower case; the cube's names in the published table where they differ.
LEGACY_NAMES = [
    "District", "Total_Children_x", "Measured_Children", "Measurement_Efficiency", "Stunted_Severe_N",
    "Stunted_Severe_Pct", "Stunted_Moderate_N", "Stunted_Moderate_Pct", "Stunted_Normal_N", "Stunted_Normal_Pct",
    "Underweight_Severe_N", "Underweight_Severe_Pct", "Underweight_Moderate_N", "Underweight_Moderate_Pct",
    "Underweight_Normal_N", "Underweight_Normal_Pct", "Stunting_Total_%", "Underweight_Total_%",
    "Measurement_Coverage_%", "Normal_Stunting_Ratio", "Normal_Underweight_Ratio", "Total_Children_0_5",
    "Measured_Children_0_5", "Measurement_Efficiency_0_5", "Stunted_Severe_N_0_5", "Stunted_Severe_Pct_0_5",
    "Stunted_Moderate_N_0_5", "Stunted_Moderate_Pct_0_5", "Stunted_Normal_N_0_5", "Stunted_Normal_Pct_0_5", "SAM (N)",
    "SAM (%)", "MAM (N)", "MAM (%)", "Not Wasted (N)", "Not Wasted (%)", "Reference data not found",
    "Underweight_Severe_N_0_5", "Underweight_Severe_Pct_0_5", "Underweight_Moderate_N_0_5",
    "Underweight_Moderate_Pct_0_5", "Underweight_Normal_N_0_5", "Underweight_Normal_Pct_0_5", "Obese (N)",
    "Obese (%)", "Overweight (N)", "Overweight (%)", "Not Overweight (N)", "Not Overweight (%)",
    "Reference data not found.1", "Stunting_Total_Pct_0_5", "Underweight_Total_Pct_0_5",
    "Measurement_Coverage_Pct_0_5", "Normal_Stunting_Ratio_0_5", "Normal_Underweight_Ratio_0_5",
    "Total Pregnant Women", "Haemoglobin Measured of PW", "Anaemic", "Total Lactating Mothers",
    "Haemoglobin Measured of LM", "Anaemic.1", "Total Children (6months - 5 years)",
    "Haemoglobin Measured of Children (6months - 5 years)", "Anaemic.2", "PW_Anaemia_Rate", "LM_Anaemia_Rate",
    "Child_Anaemia_Rate", "Total Children 0-6M", "Low Birth Weight Children 0-6M", "LBW_Rate_%", "Total_PW_x",
    "PW_Due_ANC1", "PW_Completed_ANC1", "PW_Due_ANC2", "PW_Completed_ANC2", "PW_Optimum_ANC2", "PW_Due_ANC3",
    "PW_Completed_ANC3", "PW_Optimum_ANC3", "PW_Due_ANC4", "PW_Completed_ANC4", "PW_Optimum_ANC4",
    "PW_Optimum_Latest", "PW_Hb_Measured", "PW_Anaemic_Latest", "ANC1_Completion_%", "ANC2_Completion_%",
    "ANC3_Completion_%", "ANC4_Completion_%", "Optimum_WG_Latest_%", "PW_Hb_Measured_%", "PW_Anaemia_Rate_Latest_%",
    "Total_AG", "AG_Measured", "AG_Measured_Percentage", "AG_Severely_Thin", "AG_Thin", "AG_Normal", "AG_Overweight",
    "AG_Obese", "AG_Hb_Measured", "AG_Anaemic", "AG_Measured_%", "AG_Severely_Thin_%", "AG_Thin_%", "AG_Normal_%",
    "AG_Overweight_%", "AG_Obese_%", "AG_Hb_Measured_%", "AG_Anaemia_%", "Total_Children_y", "Children_Measured",
    "ME_Percentage", "AWW_80pct_ME", "AWW_80pct_ME_%", "Total_AWW", "Target_HV", "Visits_Made", "HV_Percentage",
    "AWW_60pct_HV", "AWW_60pct_HV_%", "Project", "Sector", "AWC", "Total_Beneficiary", "Total_PW_y", "Total_LM",
    "Children_6m_3y", "Children_3y_5y", "Children_5y_6y", "SAM_6m_3y", "SAM_3y_5y", "SUW_6m_3y", "SUW_3y_6y",
    "SAM_SUW_6m_3y", "SAM_SUW_3y_5y", "AG", "Total_SAM", "Total_SUW", "SAM_Rate_%", "SUW_Rate_%", "AG_%", "Total_AWC",
    "Active_AWC", "Inactive_AWC", "New_AWC", "Inactive_AWC_Month", "Active_AWC_%", "Inactive_AWC_%",
]
LEGACY_SOURCE = {
    "Total_Children_x": "total_children", "SAM (N)": "sam_n", "SAM (%)": "sam_pct", "MAM (N)": "mam_n", "MAM (%)": "mam_pct",
    "Not Wasted (N)": "not_wasted_n", "Not Wasted (%)": "not_wasted_pct", "Obese (N)": "obese_n", "Obese (%)": "obese_pct",
    "Overweight (N)": "overweight_n", "Overweight (%)": "overweight_pct", "Not Overweight (N)": "not_overweight_n",
    "Not Overweight (%)": "not_overweight_pct", "Reference data not found.1": "reference_data_not_found_2",
    "Haemoglobin Measured of PW": "hb_measured_pw", "Anaemic": "anaemic_pw", "Haemoglobin Measured of LM": "hb_measured_lm",
    "Anaemic.1": "anaemic_lm", "Total Children (6months - 5 years)": "total_children_6m_5y",
    "Haemoglobin Measured of Children (6months - 5 years)": "hb_measured_child", "Anaemic.2": "anaemic_child",
    "Low Birth Weight Children 0-6M": "lbw_children_0_6m", "Total_AG": "total_ag_x", "AG_Measured_Percentage": "ag_measured_pct",
    "Total_Children_y": "children_total_x", "ME_Percentage": "children_measured_pct", "AWW_80pct_ME": "aww_completed_80pct_me",
    "Target_HV": "target_visits", "AG": "total_ag_y", "New_AWC": "new_awc_month",
}
PUBLISHED_NAMES = {
    **{f"{c}_{unit}": f"{c}_{shown}" for c in ("sam", "mam", "not_wasted", "obese", "overweight", "not_overweight")
       for unit, shown in (("n", "(n)"), ("pct", "(%)"))},
    "reference_data_not_found_2": "reference_data_not_found.1", "total_children_6m_5y": "total_children_(6months_-_5_years)",
}


def legacy_column(name: str) -> str:
    """The cube column that a legacy name shows unchanged."""
    return LEGACY_SOURCE.get(name) or name.lower().replace(" ", "_").replace("-", "_")


def published_names(cube: DataFrame) -> DataFrame:
    """The cube under the names of the published table."""
    return cube.withColumnsRenamed(PUBLISHED_NAMES)


def legacy_full(cube: DataFrame, key: str = "district") -> DataFrame:
    """V1 complete: all columns of the legacy cube in order. Those of
    ``legacy_view`` are derived, the others are cube columns under their legacy
    names (NULL where a cube lacks one)."""
    derived = legacy_view(cube.select("*", F.struct(*[_c(c) for c in cube.columns]).alias("__cube")), key, "__cube")
    have = set(cube.columns)
    rest = {n: F.col("__cube").getField(legacy_column(n)) if legacy_column(n) in have else F.lit(None).cast("double")
            for n in LEGACY_NAMES if n not in derived.columns}
    lead = [_c("month")] if "month" in derived.columns else []
    return derived.select(*lead, *[rest[n].alias(n) if n in rest else _c(n) for n in LEGACY_NAMES])


def legacy_view(cube: DataFrame, key: str = "district", *carry: str) -> DataFrame:
    """V1: the TitleCase / percent vocabulary derived from the cube's counts.
    Rates are ``100 * a / b`` at 2 dp; anaemia rates are zero-filled when
    nobody was measured; the rest stay NULL on a zero or missing base. Cube
    columns named in ``carry`` follow unchanged."""
    ag_total, pw_total = pick(cube, "total_ag", "x"), pick(cube, "total_pw", "x")
    if "month" in cube.columns:
        # shares of each month's total: one small per-month aggregate joined back
        tot = cube.groupBy("month").agg(F.sum(F.col("aww_completed_80pct_me").cast("double")).alias("__aww80"))
        cube = cube.join(tot, "month", "left")
        aww80 = F.col("__aww80")
    else:
        aww80 = cube.agg(F.sum(F.col("aww_completed_80pct_me").cast("double"))).scalar()
    cols = {
        **({"month": _c("month")} if "month" in cube.columns else {}),
        "District": _c(key),
        "Stunting_Total_%": _c("stunting_total_pct"),
        "Underweight_Total_%": _c("underweight_total_pct"),
        "Measurement_Efficiency": _c("measurement_efficiency"),
        "Measurement_Coverage_%": pick(cube, "measurement_coverage_pct", "x"),
        "Stunting_Total_Pct_0_5": _c("stunting_total_pct_0_5"),
        "Underweight_Total_Pct_0_5": _c("underweight_total_pct_0_5"),
        "Measurement_Coverage_Pct_0_5": _c("measurement_coverage_pct_0_5"),
        "LBW_Rate_%": pct100("lbw_children_0_6m", "total_children_0_6m"),
        "PW_Anaemia_Rate": pct100("anaemic_pw", "hb_measured_pw", True),
        "LM_Anaemia_Rate": pct100("anaemic_lm", "hb_measured_lm", True),
        "Child_Anaemia_Rate": pct100("anaemic_child", "hb_measured_child", True),
        **{f"ANC{k}_Completion_%": pct100(f"pw_completed_anc{k}", f"pw_due_anc{k}") for k in (1, 2, 3, 4)},
        "Optimum_WG_Latest_%": pct100("pw_optimum_latest", pw_total),
        "PW_Hb_Measured_%": pct100("pw_hb_measured", pw_total),
        "PW_Anaemia_Rate_Latest_%": pct100("pw_anaemic_latest", "pw_hb_measured"),
        "AG_Measured_%": pct100("ag_measured", ag_total),
        "AG_Hb_Measured_%": pct100("ag_hb_measured", ag_total),
        "AG_Severely_Thin_%": pct100("ag_severely_thin", "ag_measured"),
        "AG_Thin_%": pct100("ag_thin", "ag_measured"),
        "AG_Normal_%": pct100("ag_normal", "ag_measured"),
        "AG_Overweight_%": pct100("ag_overweight", "ag_measured"),
        "AG_Obese_%": pct100("ag_obese", "ag_measured"),
        "AG_Anaemia_%": pct100("ag_anaemic", "ag_hb_measured"),
        "AWW_80pct_ME_%": X.rnd(F.try_divide(F.col("aww_completed_80pct_me").cast("double"), aww80) * F.lit(100.0), 2),
        "HV_Percentage": _c("visit_coverage_pct"),
        "AWW_60pct_HV_%": pct100("aww_60pct_hv", "total_aww"),
        "SAM_Rate_%": pct100("sam_total", "total_beneficiary"),
        "SUW_Rate_%": pct100("suw_total", "total_beneficiary"),
        "AG_%": pct100(pick(cube, "total_ag", "y"), "total_beneficiary"),
        "Total_SAM": _c("sam_total"),
        "Total_SUW": _c("suw_total"),
        "Active_AWC_%": pct100("active_awc", "total_awc"),
        "Inactive_AWC_%": pct100("inactive_awc", "total_awc"),
    }
    return cube.select(*[c.alias(n) for n, c in cols.items()], *carry)


def bi_subset(df: DataFrame, wanted: list[str] = LEGACY_BI_COLUMNS) -> DataFrame:
    """The wanted columns that exist, in list order (pruned to the scan)."""
    return df.select(*[_c(c) for c in wanted if c in df.columns])


def scatter_points(df: DataFrame, pairs=SCATTER_PAIRS, key: str = "District") -> DataFrame:
    """B2: (pair, key, x, y) for each configured pair whose columns exist,
    rows with a NULL dropped."""
    parts = []
    for x, y in pairs:
        if x not in df.columns or y not in df.columns:
            continue
        sub = listwise_drop(df.select(_c(key), _c(x).cast("double").alias("x"), _c(y).cast("double").alias("y")),
                            [key, "x", "y"])
        parts.append(sub.select(F.lit(f"{y} vs {x}").alias("pair"), _c(key), "x", "y"))
    if not parts:
        return df.select(F.lit("").alias("pair"), _c(key), F.lit(0.0).alias("x"), F.lit(0.0).alias("y")).limit(0)
    return reduce(lambda a, b: a.unionByName(b), parts)


def available_keys(cube: DataFrame, key: str = "District") -> DataFrame:
    """A3: sorted distinct non-null keys."""
    return cube.select(_c(key)).where(_c(key).isNotNull()).distinct().orderBy(_c(key))


def _norm(c):
    return F.lower(X.strip(c))


GRAM_KEYS = 10_000               # keys of one gram that a task compares


def lookup(requests: DataFrame, req_id: str, req_name: str, cube: DataFrame,
           key: str = "District") -> DataFrame:
    """L1-L3 for a table of requests.

    Exact: stripped, case-folded equality. Fallback, only for requests with
    no exact match: the request is a literal substring of a key; the first
    key in key order wins. Otherwise ``not_found``.

    Each distinct request text is resolved once. A text of up to two characters
    is looked up among the keys' substrings of its length. A longer one meets the
    keys over its rarest three-character gram only (grams are counted over the
    keys first; one that no key has ends the search), and ``contains`` decides.
    The keys of a gram that is rarest nowhere else than in most keys are dealt over
    slices of ``GRAM_KEYS`` keys, and the texts that need it visit each slice, so
    such a gram is spread over tasks. The resolved texts then join back to the
    requests, one to many.
    """
    keys = cube.select(_c(key).alias("__key")).where(F.col("__key").isNotNull()).distinct()
    keys = materialize(keys.withColumn("__nk", _norm(F.col("__key"))), "lookup-keys")
    req = requests.select(_c(req_id).alias("request_id"), _c(req_name).alias("request"),
                          _norm(_c(req_name)).alias("__q"))
    texts = req.select("__q").where(F.col("__q").isNotNull()).distinct()
    exact = keys.groupBy(F.col("__nk").alias("__q")).agg(F.min("__key").alias("__exact"))
    texts = materialize(texts.join(exact, "__q", "left"), "lookup-texts")
    open_ = texts.where(F.col("__exact").isNull()).select("__q")
    grams = lambda c, n: F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c) - n + 1), lambda i: F.substring(F.col(c), i, n)))
    size = F.explode(F.sequence(F.lit(0), F.least(F.lit(2), F.length("__nk")))).alias("__n")
    short = keys.select("__key", "__nk", size).select("__key", F.explode(grams("__nk", F.col("__n"))).alias("__q")) \
        .groupBy("__q").agg(F.min("__key").alias("__part"))
    held = keys.where(F.length("__nk") >= 3).select("__key", "__nk", F.explode(grams("__nk", F.lit(3))).alias("__g"))
    counts = held.groupBy("__g").agg(F.count(F.lit(1)).alias("__c"))
    asked = open_.where(F.length("__q") >= 3).select("__q", F.explode(grams("__q", F.lit(3))).alias("__g"))
    rarest = asked.join(counts, "__g", "left").groupBy("__q").agg(F.min(F.struct(F.coalesce("__c", F.lit(0)).alias("c"), F.col("__g").alias("g"))).alias("r")) \
        .where("r.c > 0").select("__q", F.col("r.g").alias("__g"), F.ceil(F.col("r.c") / GRAM_KEYS).cast("int").alias("__s"))
    used = rarest.select("__g", "__s").distinct()
    slices = held.join(used, "__g").withColumn("__at", F.pmod(F.xxhash64("__nk"), F.col("__s")).cast("int"))
    visits = rarest.select("__q", "__g", F.explode(F.sequence(F.lit(0), F.col("__s") - 1)).alias("__at"))
    long = visits.join(slices.select("__g", "__at", "__key", "__nk"), ["__g", "__at"]).where(F.contains("__nk", "__q")) \
        .groupBy("__q").agg(F.min("__key").alias("__part"))
    part = open_.where(F.length("__q") < 3).join(short, "__q").unionByName(long)
    out = req.join(texts.join(part, "__q", "left"), "__q", "left")
    return out.select(
        "request_id", "request",
        F.coalesce("__exact", "__part").alias("match"),
        F.when(F.col("__exact").isNotNull(), F.lit("exact"))
         .when(F.col("__part").isNotNull(), F.lit("contains"))
         .otherwise(F.lit("not_found")).alias("status"))


def lookup_records(requests: DataFrame, req_id: str, req_name: str, cube: DataFrame,
                   key: str = "District", full: DataFrame | None = None, full_key: str = "district") -> DataFrame:
    """Every request with its status, the matched key and that
    key's structured profile; ``raw`` is the JSON of all columns of ``full``
    (the cube itself, say) or else of ``cube``. If some request was not found,
    one row per available key with status ``available`` follows, in place of
    a copy of the list in every such request."""
    found = lookup(requests, req_id, req_name, cube, key)
    shown = structured_profile(cube, key, with_raw=full is None)
    if full is not None:
        shown = shown.join(full.select(_c(full_key).alias("district"), _json(full).alias("raw")), "district", "left")
    groups = [c for c in shown.columns if c != "district"]
    records = found.join(shown.withColumnRenamed("district", "match"), "match", "left") \
        .select("request_id", "request", "match", "status", *groups)
    some = found.where(F.col("status") == "not_found").limit(1).select(F.lit("available").alias("status"))
    keys = cube.select(_c(key).alias("match")).where(_c(key).isNotNull()).distinct().withColumn("status", F.lit("available"))
    return records.unionByName(keys.join(some, "status", "left_semi"), allowMissingColumns=True)


def _json(df: DataFrame):
    """All columns of a row as JSON, NaN as null."""
    return F.to_json(F.struct(*[X.nan_to_null(_c(f.name)).alias(f.name) if f.dataType.typeName() in ("double", "float")
                                else _c(f.name) for f in df.schema.fields]), {"ignoreNullFields": "false"})


def structured_profile(cube: DataFrame, key: str = "District", with_raw: bool = True) -> DataFrame:
    """One nested record per key; NaN becomes NULL; ``raw`` carries
    every column as JSON."""
    def v(name):
        return X.nan_to_null(_c(name)) if name in cube.columns else F.lit(None).cast("double")

    # fixed values: the group and field names of a profile
    cols = [
        _c(key).alias("district"),
        F.struct(v("Stunting_Total_%").alias("stunting_pct"), v("Underweight_Total_%").alias("underweight_pct"),
                 v("Measurement_Efficiency").alias("measurement_efficiency")).alias("stunting_5_6"),
        F.struct(v("Stunting_Total_Pct_0_5").alias("stunting_pct"),
                 v("Underweight_Total_Pct_0_5").alias("underweight_pct"),
                 v("Measurement_Coverage_Pct_0_5").alias("measurement_coverage")).alias("stunting_0_5"),
        F.struct(v("PW_Anaemia_Rate").alias("pw_anaemia_rate"),
                 v("Optimum_WG_Latest_%").alias("optimum_weight_gain")).alias("maternal_indicators"),
        F.struct(v("HV_Percentage").alias("home_visit_pct"),
                 v("Active_AWC_%").alias("active_awc_pct")).alias("service_delivery"),
    ]
    if with_raw:
        cols.append(_json(cube).alias("raw"))
    return cube.select(*cols)
