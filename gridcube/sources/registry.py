"""Declarative source registry: one entry per monthly source.

A source is described by its file-name template, the month offset of its
file (the SNP file carries next month's projection), the header variant,
and a positional schema contract: (raw header, canonical column, type) in
file order. The scan checks the file's header against the contract and then
applies the canonical schema by position, so repeated or blank raw headers
never matter.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

L, D, S = "long", "double", "string"


@dataclass(frozen=True)
class SourceSpec:
    name: str
    file_template: str          # {mm} {yyyy} are filled from the file's month
    variant: str                # header variant in functions.headers.VARIANTS
    columns: tuple              # ((raw header, canonical, type), ...)
    month_offset: int = 0       # file month = data month + offset
    in_cube: bool = True
    is_base: bool = False
    header_prefix_match: bool = False   # raw headers carry month text: match the prefix
    required: tuple = field(default=("district",))

    @property
    def canonical(self) -> list[str]:
        return [c for _, c, _ in self.columns]

    @property
    def raw(self) -> list[str]:
        return [r for r, _, _ in self.columns]

    def schema(self) -> T.StructType:
        tmap = {L: T.LongType(), D: T.DoubleType(), S: T.StringType()}
        return T.StructType([T.StructField(c, tmap[t], True) for _, c, t in self.columns])

    def file_name(self, month: str) -> str:
        y, m = month.split("-")
        yi, mi = int(y), int(m) + self.month_offset
        yi, mi = yi + (mi - 1) // 12, (mi - 1) % 12 + 1
        return self.file_template.format(mm=f"{mi:02d}", yyyy=f"{yi:04d}")


# File names and header contracts of the monthly exports,
# in file column order (raw header text, canonical name, type).
_GROWTH_COMMON = (
    ("District", "district", S),
    ("Total Active Children Registered in the AWC for the Month", "total_children", L),
    ("Total Active Children measured (Height & Weight) for the Month", "measured_children", L),
    ("Measurement efficiency (%)", "measurement_efficiency", D),
    ("Severely stunted (N)", "stunted_severe_n", L),
    ("Severely stunted (%)", "stunted_severe_pct", D),
    ("Moderately stunted (N)", "stunted_moderate_n", L),
    ("Moderately stunted (%)", "stunted_moderate_pct", D),
    ("Not stunted (N)", "stunted_normal_n", L),
    ("Not stunted (%)", "stunted_normal_pct", D),
)
_UNDERWEIGHT = (
    ("Severely underweight (N)", "underweight_severe_n", L),
    ("Severely underweight (%)", "underweight_severe_pct", D),
    ("Moderately underweight (N)", "underweight_moderate_n", L),
    ("Moderately underweight (%)", "underweight_moderate_pct", D),
    ("Not underweight (N)", "underweight_normal_n", L),
    ("Not underweight (%)", "underweight_normal_pct", D),
)


def _suffix(cols, sfx):
    return tuple((r, c if c == "district" else c + sfx, t) for r, c, t in cols)


SOURCES: dict[str, SourceSpec] = {
    "gm_5_6": SourceSpec(
        "gm_5_6", "(5_to_6_Years)_Growth_Monitoring_{mm}_{yyyy}.csv", "base",
        _GROWTH_COMMON + _UNDERWEIGHT, is_base=True),
    "gm_0_5": SourceSpec(
        "gm_0_5", "(0_to_5_Years)_Growth_Monitoring_{mm}_{yyyy}.csv", "base",
        _suffix(_GROWTH_COMMON, "_0_5") + (
            ("SAM (N)", "sam_n", L), ("SAM (%)", "sam_pct", D),
            ("MAM (N)", "mam_n", L), ("MAM (%)", "mam_pct", D),
            ("Not Wasted (N)", "not_wasted_n", L), ("Not Wasted (%)", "not_wasted_pct", D),
            ("Reference data not found", "reference_data_not_found", L),
        ) + _suffix(_UNDERWEIGHT, "_0_5") + (
            ("Obese (N)", "obese_n", L), ("Obese (%)", "obese_pct", D),
            ("Overweight (N)", "overweight_n", L), ("Overweight (%)", "overweight_pct", D),
            ("Not Overweight (N)", "not_overweight_n", L), ("Not Overweight (%)", "not_overweight_pct", D),
            ("Reference data not found", "reference_data_not_found_2", L),
        )),
    "anaemia": SourceSpec(
        "anaemia", "Anaemia_{mm}_{yyyy}.csv", "base", (
            ("District", "district", S),
            ("Total Pregnant Women", "total_pregnant_women", L),
            ("Haemoglobin Measured of PW", "hb_measured_pw", L),
            ("Anaemic", "anaemic_pw", L),
            ("Total Lactating Mothers", "total_lactating_mothers", L),
            ("Haemoglobin Measured of LM", "hb_measured_lm", L),
            ("Anaemic", "anaemic_lm", L),
            ("Total Children (6months - 5 years)", "total_children_6m_5y", L),
            ("Haemoglobin Measured of Children (6months - 5 years)", "hb_measured_child", L),
            ("Anaemic", "anaemic_child", L),
        )),
    "lbw": SourceSpec(
        "lbw", "Low_Birth_Weight_{mm}_{yyyy}.csv", "lbw", (
            ("District", "district", S),
            ("Total Children 0-6M", "total_children_0_6m", L),
            ("Low Birth Weight Children 0-6M", "lbw_children_0_6m", L),
        ), required=("district", "total_children_0_6m", "lbw_children_0_6m")),
    "gwg": SourceSpec(
        "gwg", "Gestational_Weight_Gain_Report_{mm}_{yyyy}.csv", "gwg", (
            ("DISTRICT", "district", S),
            ("TOTAL ACTIVE  PREGNANT WOMEN", "total_pw", L),
            ("NO. OF PW DUE ANC 1", "pw_due_anc1", L),
            ("NO. OF PW COMPLETED ANC 1", "pw_completed_anc1", L),
            ("NO. OF PW DUE ANC 2", "pw_due_anc2", L),
            ("NO. OF PW COMPLETED ANC 2", "pw_completed_anc2", L),
            ("NO. OF PW GAINED OPTIMUM WEIGHT IN ANC 2", "pw_optimum_anc2", L),
            ("NO. OF PW DUE ANC 3", "pw_due_anc3", L),
            ("NO. OF PW COMPLETED ANC 3", "pw_completed_anc3", L),
            ("NO. OF PW GAINED OPTIMUM WEIGHT IN ANC 3", "pw_optimum_anc3", L),
            ("NO. OF PW DUE ANC 4", "pw_due_anc4", L),
            ("NO. OF PW COMPLETED ANC 4", "pw_completed_anc4", L),
            ("NO. OF PW GAINED OPTIMUM WEIGHT IN ANC 4", "pw_optimum_anc4", L),
            ("TOTAL NO. OF PW GAINED OPTIMUM WEIGHT AS PER LATEST ANC", "pw_optimum_latest", L),
            ("TOTAL HAEMOGLOBIN MEASURED AS PER LATEST ANC", "pw_hb_measured", L),
            ("TOTAL ANAEMIC AS PER LATEST ANC", "pw_anaemic_latest", L),
        )),
    "ag": SourceSpec(
        "ag", "Adolescent_Girls_(14_18_Years)_{mm}_{yyyy}.csv", "ag", (
            ("District", "district", S),
            ("Total Active AG", "total_ag", L),
            ("Active AG Measured (Height & Weight)", "ag_measured", L),
            ("% of AG measured", "ag_measured_pct", S),
            ("Severely Thin", "ag_severely_thin", L),
            ("Thin", "ag_thin", L),
            ("Normal", "ag_normal", L),
            ("Overweight", "ag_overweight", L),
            ("Obese", "ag_obese", L),
            ("Haemoglobin Measured", "ag_hb_measured", L),
            ("Anaemic", "ag_anaemic", L),
        )),
    "me": SourceSpec(
        "me", "Measuring_Efficiency_Children_0_to_6_years_{mm}_{yyyy}.csv", "me", (
            ("District", "district", S),
            ("Total Active Children", "children_total", L),
            ("Total Active Children Measured", "children_measured", L),
            ("% Children Measured", "children_measured_pct", D),
            ("AWW Completed 80% of ME", "aww_completed_80pct_me", L),
        )),
    "hv": SourceSpec(
        "hv", "Home_Visit_{mm}_{yyyy}.csv", "base", (
            ("District", "district", S),
            ("Total AWW Between", "total_aww", L),
            ("Total targeted visits Between", "target_visits", L),
            ("Total visits made Between", "visits_made", L),
            ("% of visits made Between", "visit_coverage_pct", S),
            ("AWW completed 60% HV Between", "aww_60pct_hv", L),
        ), header_prefix_match=True),
    "snp": SourceSpec(
        "snp", "SNP_Projections_{mm}_{yyyy}.csv", "snp", (
            ("District", "district", S),
            ("Project", "project", L),
            ("Sector", "sector", L),
            ("AWC", "awc", L),
            ("Total Beneficiary", "total_beneficiary", L),
            ("Total PW", "total_pw", L),
            ("Total LM", "total_lm", L),
            ("Total Children (6m to 3yr)", "children_6m_3y", L),
            ("Total Children (3yr to 5yr)", "children_3y_5y", L),
            ("Total Children (5yr to 6yr)", "children_5y_6y", L),
            ("Total SAM children (6m to 3yr)", "sam_6m_3y", L),
            ("Total SAM children (3 yr to 5 yr)", "sam_3y_5y", L),
            ("Total SUW children (6m to 3yr)", "suw_6m_3y", L),
            ("Total SUW children (3yr to 6yr)", "suw_3y_6y", L),
            ("Total SAM with SUW Children (6m-3y)", "sam_suw_6m_3y", L),
            ("Total SAM with SUW Children (3y-5y)", "sam_suw_3y_5y", L),
            ("Adolescent Girls", "total_ag", L),
        ), month_offset=1),
    "awc": SourceSpec(
        "awc", "AWC_{mm}_{yyyy}.csv", "base", (
            ("District", "district", S),
            ("Total AWC", "total_awc", L),
            ("Total Active AWC", "active_awc", L),
            ("Total Inactive AWC", "inactive_awc", L),
            ("Newly Added AWC during Month", "new_awc_month", L),
            ("Inactive AWC during Month", "inactive_awc_month", L),
        )),
    "awc_staff": SourceSpec(
        "awc_staff", "AWC_Staff_{mm}_{yyyy}.csv", "base", (
            ("District", "district", S),
            ("Total AWC Operational", "total_awc_operational", L),
            ("AWW", "aww", L),
            ("AWW on Additional Charges", "aww_on_additional_charges", L),
            ("AWH", "awh", L),
        ), in_cube=False),
    "vhsnd_cbe": SourceSpec(
        "vhsnd_cbe", "VHSND_and_CBE_{mm}_{yyyy}.csv", "base", (
            ("District", "district", S),
            ("Total AWC", "total_awc", L),
            ("Total CBE", "total_cbe", L),
            ("Total VHSND", "total_vhsnd", L),
            ("Field Functionaries", "field_functionaries", L),
            ("Total Participants", "total_participants", L),
            ("Vaccinations", "vaccinations", L),
        ), in_cube=False),
    "me_status": SourceSpec(
        "me_status", "Measurement_Efficiency_Status_{mm}_{yyyy} (1).csv", "base", (
            ("", "row_label", S),
            ("CATEGORY", "category", S),
            ("TOTAL ACTIVE CHILDREN", "total_active_children", L),
            ("TOTAL ACTIVE CHILDREN MEASURED", "total_active_children_measured", L),
            ("MEASUREMENT EFFICIENCY (%)", "measurement_efficiency", D),
        ), in_cube=False, required=()),
}

# Join order of the cube: the base source first, then the others.
CUBE_ORDER = ["gm_5_6", "gm_0_5", "anaemia", "lbw", "gwg", "ag", "me", "hv", "snp", "awc"]


def header_matches(spec: SourceSpec, raw_header: list[str]) -> list[tuple[str, str, bool]]:
    """Compare a file's raw header with the contract, position by position.

    Returns (expected, found, ok) per contract column. Comparison ignores
    case and surrounding/duplicated whitespace.
    """
    def norm(s):
        return " ".join((s or "").split()).lower()

    out = []
    for i, (raw, _, _) in enumerate(spec.columns):
        found = raw_header[i] if i < len(raw_header) else None
        if found is None:
            ok = False
        elif spec.header_prefix_match and raw:
            ok = norm(found).startswith(norm(raw))
        else:
            ok = norm(found) == norm(raw)
        out.append((raw, found, ok))
    return out
