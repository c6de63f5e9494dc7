"""SQL text for the DuckDB oracle.

Written independently of the Spark operators: the same semantics (numpy
rounding, zero-safe ratios, Python title case, pandas-style suffixing) in
plain ANSI-ish SQL that DuckDB runs over the driver's parquet views. Only the
fixture conditions in ``analogues`` (which TPC-H rows count as what) are
shared, since they define the input, not the operator under test.
"""

from __future__ import annotations

from gridcube.plans import analogues as A


def qi(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def d(e: str) -> str:
    return f"CAST({e} AS DOUBLE)"


def rnd(e: str, n: int = 2) -> str:
    s = 10 ** n
    return f"(round_even(({e}) * {s}::DOUBLE, 0) / {s}::DOUBLE)"


def ratio(a: str, b: str) -> str:
    return f"({d(a)} / NULLIF({d(b)}, 0))"


def safe_ratio(a: str, b: str, n: int = 2) -> str:
    x, y = (f"CASE WHEN isnan({d(e)}) THEN NULL ELSE {d(e)} END" for e in (a, b))
    return f"coalesce({rnd(ratio(f'({x})', f'({y})'), n)}, 0.0::DOUBLE)"


def pct(a: str, b: str, n: int = 2) -> str:
    return rnd(f"{ratio(a, b)} * 100::DOUBLE", n)


def inf0(a: str, b: str, n: int = 2) -> str:
    return (f"(CASE WHEN {d(b)} = 0 AND {d(a)} <> 0 THEN 0.0::DOUBLE "
            f"ELSE {rnd(ratio(a, b), n)} END)")


def lenient(e: str, n: int = 2) -> str:
    plain = "regexp_matches({0}, '^\\s*[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?\\s*$')".format(e)
    v = f"CASE WHEN {plain} THEN TRY_CAST(trim({e}) AS DOUBLE) END"
    return rnd(f"coalesce(CASE WHEN isfinite({v}) THEN {v} END, 0::DOUBLE)", n)


def title(e: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all({e}, '(\\p{{L}}+|\\P{{L}}+)', 1), "
            f"lambda w: upper(w[1]) || lower(w[2:])), '')")


def strip(e: str) -> str:
    """Python's str.strip: every Unicode separator, ASCII controls and NEL."""
    ws = "[\\t-\\r\\x1c-\\x20\\x{85}\\p{Z}]"
    return f"regexp_replace({e}, '^{ws}+|{ws}+$', '', 'g')"


def clean_key(e: str) -> str:
    return f"replace(replace({title(strip(e))}, '–', '-'), '  ', ' ')"


def normalize_header(e: str, variant: str) -> str:
    """Header normalisation (strip, lower, ' ' -> '_', then the variant's
    literal replacements in order) as a SQL expression."""
    from gridcube.functions.headers import VARIANTS
    s = f"replace(lower({strip(e)}), ' ', '_')"
    for old, new in VARIANTS[variant]:
        s = f"replace({s}, '{old}', '{new}')"
    return s


def zfill(e: str, w: int = 11) -> str:
    s = f"CAST({e} AS VARCHAR)"
    return (f"(CASE WHEN length({s}) >= {w} THEN {s} "
            f"WHEN left({s}, 1) IN ('-', '+') THEN left({s}, 1) || lpad(substr({s}, 2), {w - 1}, '0') "
            f"ELSE lpad({s}, {w}, '0') END)")


def cnt(cond: str) -> str:
    return f"CAST(count(*) FILTER (WHERE {cond}) AS BIGINT)"


def corr(a: str, b: str) -> str:
    """Pearson on jointly non-null rows, NULL for constant input."""
    return f"(CASE WHEN isnan(corr({d(a)}, {d(b)})) THEN NULL ELSE corr({d(a)}, {d(b)}) END)"


def with_clause(ctes: list[tuple[str, str]]) -> str:
    return "WITH " + ",\n".join(f"{n} AS (\n{body}\n)" for n, body in ctes)


# ---------------------------------------------------------------- sources

NAT = "n.n_name, n.n_regionkey"


SHIP_M = "strftime(l_shipdate, '%Y-%m')"
ORDER_M = "strftime(o_orderdate, '%Y-%m')"


def _lines_ctes(monthly: bool = False) -> list[tuple[str, str]]:
    flags = A.LINE_FLAGS
    m_sel, m_grp = (f"{SHIP_M} AS month, ", ", month") if monthly else ("", "")
    n_sel, n_grp = ("month, ", ", month") if monthly else ("", "")
    per_sup = ",\n  ".join(
        [f"{cnt(c)} AS {qi(k)}" for k, c in flags.items()] +
        [f"{cnt(f'({c}) AND {A.EARLY}')} AS {qi('e_' + k)}" for k, c in flags.items()] +
        ["CAST(sum(l_quantity) AS BIGINT) AS qty",
         f"CAST(sum(CASE WHEN {A.F_} THEN l_quantity ELSE 0 END) AS BIGINT) AS qty_f"])
    sums = ",\n  ".join([f"CAST(sum({qi(k)}) AS BIGINT) AS {qi(k)}" for k in flags] +
                        [f"CAST(sum({qi('e_' + k)}) AS BIGINT) AS {qi('e_' + k)}" for k in flags] +
                        ["CAST(sum(qty) AS BIGINT) AS qty", "CAST(sum(qty_f) AS BIGINT) AS qty_f",
                         "CAST(count(*) AS BIGINT) AS n_sup",
                         "CAST(count(*) FILTER (WHERE qty_f * 2 >= qty) AS BIGINT) AS n_sup_half"])
    return [
        ("li_sup", f"SELECT l_suppkey, {m_sel}\n  {per_sup}\nFROM lineitem GROUP BY l_suppkey{m_grp}"),
        ("li_nat", f"SELECT {NAT}, {n_sel}\n  {sums}\nFROM li_sup JOIN supplier s ON li_sup.l_suppkey = s.s_suppkey "
                   f"JOIN nation n ON s.s_nationkey = n.n_nationkey GROUP BY {NAT}{n_grp}"),
    ]


def _orders_ctes(monthly: bool = False) -> list[tuple[str, str]]:
    cols = ",\n  ".join(f"{cnt(c)} AS {qi(k)}" for k, c in A.ORDER_FLAGS.items())
    m_sel, m_grp = (f"{ORDER_M} AS month, ", ", month") if monthly else ("", "")
    return [("ord_nat", f"SELECT {NAT}, {m_sel}\n  {cols}\nFROM orders o JOIN customer c ON o.o_custkey = c.c_custkey "
                        f"JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY {NAT}{m_grp}")]


def _cust_ctes() -> list[tuple[str, str]]:
    cols = ",\n  ".join(f"{cnt(c)} AS {qi(k)}" for k, c in A.CUST_FLAGS.items())
    return [("cust_nat",
             f"SELECT {NAT},\n  {cols},\n  CAST(coalesce((SELECT count(*) FROM supplier s "
             f"WHERE s.s_nationkey = n.n_nationkey), 0) AS BIGINT) AS n_suppliers\n"
             f"FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY {NAT}, n.n_nationkey")]


def _growth(p: str, sfx: str) -> list[tuple[str, str]]:
    m = qi(p + "meas")
    cols = [("total_children" + sfx, qi(p + "all")), ("measured_children" + sfx, m),
            ("measurement_efficiency" + sfx, pct(m, qi(p + "all")))]
    head, tail = [], []
    for short, name in (("st_sev", "stunted_severe"), ("st_mod", "stunted_moderate"), ("st_nor", "stunted_normal")):
        head += [(f"{name}_n{sfx}", qi(p + short)), (f"{name}_pct{sfx}", pct(qi(p + short), m))]
    for short, name in (("uw_sev", "underweight_severe"), ("uw_mod", "underweight_moderate"),
                        ("uw_nor", "underweight_normal")):
        tail += [(f"{name}_n{sfx}", qi(p + short)), (f"{name}_pct{sfx}", pct(qi(p + short), m))]
    return cols + head, tail


def _sel(cols: list[tuple[str, str]]) -> str:
    return ",\n  ".join(f"{e} AS {qi(n)}" for n, e in cols)


DATED = {"li_nat", "ord_nat"}


def source_columns(monthly: bool = False) -> dict[str, tuple[str, list[tuple[str, str]], str]]:
    """source -> (from-CTE, [(column, expr)], mode); dated sources get a
    leading ``month`` column when ``monthly``."""
    spec = _source_columns()
    if not monthly:
        return spec
    return {k: (frm, ([("month", "month")] + cols) if frm in DATED else cols, mode)
            for k, (frm, cols, mode) in spec.items()}


def _source_columns() -> dict[str, tuple[str, list[tuple[str, str]], str]]:
    h, t = _growth("", "")
    eh, et = _growth("e_", "_0_5")
    early = eh + [("sam_n", qi("e_sam")), ("sam_pct", pct(qi("e_sam"), qi("e_meas"))),
                  ("mam_n", qi("e_mam")), ("mam_pct", pct(qi("e_mam"), qi("e_meas"))),
                  ("not_wasted_n", "e_meas - e_sam - e_mam"), ("not_wasted_pct", pct("(e_meas - e_sam - e_mam)", qi("e_meas"))),
                  ("reference_data_not_found", "e_all - e_meas")] + et
    for k, n in (("e_uw_sev", "obese"), ("e_uw_mod", "overweight"), ("e_uw_nor", "not_overweight")):
        early += [(f"{n}_n", qi(k)), (f"{n}_pct", pct(qi(k), qi("e_meas")))]
    early.append(("reference_data_not_found_2", "e_all - e_meas"))
    gwg = [("total_pw", "o_all")]
    for k in (1, 2, 3, 4):
        gwg += [(f"pw_due_anc{k}", f"due{k}"), (f"pw_completed_anc{k}", f"done{k}")]
        if k > 1:
            gwg.append((f"pw_optimum_anc{k}", f"opt{k}"))
    gwg += [("pw_optimum_latest", "opt_latest"), ("pw_hb_measured", "hb_latest"),
            ("pw_anaemic_latest", "an_latest")]
    cov = (f"CASE WHEN n_regionkey = 0 THEN 'n/a' ELSE "
           f"CAST({rnd(f'{ratio('qty_f', 'qty')} * 100::DOUBLE', 4)} AS VARCHAR) END")
    return {
        "gm_5_6": ("li_nat", [("district", "n_name")] + h + t, ""),
        "gm_0_5": ("li_nat", [("district", "coalesce(n_name, 'Total')")] + early, "ROLLUP"),
        "anaemia": ("ord_nat", [("district", "'  ' || lower(n_name) || ' '"),
                                ("total_pregnant_women", "pw_tot"), ("hb_measured_pw", "pw_hb"),
                                ("anaemic_pw", "pw_an"), ("total_lactating_mothers", "lm_tot"),
                                ("hb_measured_lm", "lm_hb"), ("anaemic_lm", "lm_an"),
                                ("total_children_6m_5y", "ch_tot"), ("hb_measured_child", "ch_hb"),
                                ("anaemic_child", "ch_an")], ""),
        "lbw": ("cust_nat", [("district", "upper(n_name)"), ("total_children_0_6m", "c_all"),
                             ("lbw_children_0_6m", "neg")], ""),
        "gwg": ("ord_nat", [("district", "n_name")] + gwg, ""),
        "ag": ("ag_nat", [("district", "n_name"), ("total_ag", "total_ag"), ("ag_measured", "ag_measured"),
                          ("ag_measured_pct", f"CASE WHEN n_regionkey = 1 THEN 'NaN' ELSE CAST({pct('ag_measured', 'total_ag', 4)} AS VARCHAR) END")]
               + [(k, qi(k)) for k in A.AG_FLAGS if k not in ("total_ag", "ag_measured")], ""),
        "me": ("li_nat", [("district", "n_name"), ("children_total", qi("all")),
                          ("children_measured", "meas"), ("children_measured_pct", pct("meas", qi("all"))),
                          ("aww_completed_80pct_me", "q40")], ""),
        "hv": ("li_nat", [("district", "n_name"), ("total_aww", "n_sup"), ("target_visits", "qty"),
                          ("visits_made", "qty_f"), ("visit_coverage_pct", cov),
                          ("aww_60pct_hv", "n_sup_half")], ""),
        "snp": ("cust_nat", [("district", "n_name"), ("project", "pos"), ("sector", "neg"), ("awc", "n_suppliers"),
                             ("total_beneficiary", "c_all"), ("total_pw", "seg_auto"),
                             ("total_lm", "seg_build"), ("children_6m_3y", "seg_furn"),
                             ("children_3y_5y", "seg_house"), ("children_5y_6y", "seg_mach"),
                             ("sam_6m_3y", "sam_a"), ("sam_3y_5y", "sam_b"), ("suw_6m_3y", "suw_a"),
                             ("suw_3y_6y", "suw_b"), ("sam_suw_6m_3y", "ss_a"), ("sam_suw_3y_5y", "ss_b"),
                             ("total_ag", "n_suppliers")], ""),
        "awc": ("cust_nat", [("district", "n_name"), ("total_awc", "c_all"), ("active_awc", "pos"),
                             ("inactive_awc", "nonpos"), ("new_awc_month", "rich"),
                             ("inactive_awc_month", "deep")], ""),
    }


def base_ctes(sources: list[str], monthly: bool = False) -> list[tuple[str, str]]:
    """CTEs needed to produce raw analogue tables ``src_<name>``."""
    spec = source_columns(monthly)
    need = {spec[s][0] for s in sources}
    ctes: list[tuple[str, str]] = []
    if "li_nat" in need:
        ctes += _lines_ctes(monthly)
    if "ord_nat" in need:
        ctes += _orders_ctes(monthly)
    if "cust_nat" in need:
        ctes += _cust_ctes()
    if "ag_nat" in need:
        cols = ",\n  ".join(f"{cnt(c)} AS {qi(k)}" for k, c in A.AG_FLAGS.items())
        ctes.append(("ag_nat", f"SELECT {NAT},\n  {cols}\nFROM supplier s JOIN nation n "
                               f"ON s.s_nationkey = n.n_nationkey WHERE {A.AG_FILTER} GROUP BY {NAT}"))
    for s in sources:
        frm, cols, mode = spec[s]
        if mode == "ROLLUP":
            # roll the early-band counts up with a grand-total row
            e_keys = [f"e_{k}" for k in A.LINE_FLAGS]
            sums = ", ".join(f"CAST(sum({qi(k)}) AS BIGINT) AS {qi(k)}" for k in e_keys)
            if monthly:
                ctes.append(("li_roll", f"SELECT month, n_name, {sums} FROM li_nat "
                                        f"GROUP BY GROUPING SETS ((month, n_name), (month))"))
            else:
                ctes.append(("li_roll", f"SELECT n_name, {sums} FROM li_nat GROUP BY ROLLUP (n_name)"))
            ctes.append((f"src_{s}", f"SELECT\n  {_sel(cols)}\nFROM li_roll"))
        else:
            ctes.append((f"src_{s}", f"SELECT\n  {_sel(cols)}\nFROM {frm}"))
    return ctes


def source_names(source: str, monthly: bool = False) -> list[str]:
    return [n for n, _ in source_columns(monthly)[source][1]]


# ------------------------------------------------------------- indicators

def _growth_ind(sfx: str) -> list[list[tuple[str, str]]]:
    return [
        [("stunting_total_pct" + sfx, rnd(f"stunted_severe_pct{sfx} + stunted_moderate_pct{sfx}")),
         ("underweight_total_pct" + sfx, rnd(f"underweight_severe_pct{sfx} + underweight_moderate_pct{sfx}")),
         ("measurement_coverage_pct" + sfx, pct(f"measured_children{sfx}", f"total_children{sfx}"))],
        [("normal_stunting_ratio" + sfx, inf0(f"stunted_normal_pct{sfx}", f"stunting_total_pct{sfx}")),
         ("normal_underweight_ratio" + sfx, inf0(f"underweight_normal_pct{sfx}", f"underweight_total_pct{sfx}"))],
    ]


def indicator_layers(source: str, monthly: bool = False) -> list[list[tuple[str, str]]]:
    """Derived columns per source, as dependent layers (later layers may
    use earlier ones)."""
    if source == "gm_5_6":
        return _growth_ind("")
    if source == "gm_0_5":
        return _growth_ind("_0_5")
    if source == "anaemia":
        return [[("pw_anaemia_rate", safe_ratio("anaemic_pw", "hb_measured_pw")),
                 ("lm_anaemia_rate", safe_ratio("anaemic_lm", "hb_measured_lm")),
                 ("child_anaemia_rate", safe_ratio("anaemic_child", "hb_measured_child"))]]
    if source == "lbw":
        return [[("lbw_rate_pct", safe_ratio("lbw_children_0_6m", "total_children_0_6m"))]]
    if source == "gwg":
        return [[(f"anc{k}_completion_pct", safe_ratio(f"pw_completed_anc{k}", f"pw_due_anc{k}"))
                 for k in (1, 2, 3, 4)] +
                [("optimum_wg_latest_pct", safe_ratio("pw_optimum_latest", "total_pw")),
                 ("pw_hb_measured_pct", safe_ratio("pw_hb_measured", "total_pw")),
                 ("pw_anaemia_latest_pct", safe_ratio("pw_anaemic_latest", "pw_hb_measured"))]]
    if source == "ag":
        return [[("ag_measured_pct", lenient("ag_measured_pct")),
                 ("ag_underweight", "coalesce(ag_severely_thin, 0) + coalesce(ag_thin, 0)")],
                [("ag_underweight_pct", safe_ratio("ag_underweight", "total_ag")),
                 ("ag_anaemia_rate", safe_ratio("ag_anaemic", "ag_hb_measured"))]]
    if source == "me":
        within = " t WHERE t.month = src_me.month" if monthly else ""
        share = (f"coalesce({rnd(f'{d('aww_completed_80pct_me')} / NULLIF((SELECT sum({d('aww_completed_80pct_me')}) '
                            f'FROM src_me{within}), 0)')}, 0.0::DOUBLE)")
        return [[("measurement_coverage_pct", safe_ratio("children_measured", "children_total")),
                 ("aww_80pct_me_share", share)]]
    if source == "hv":
        return [[("visit_coverage_pct", lenient("visit_coverage_pct")),
                 ("aww_60pct_hv_pct", safe_ratio("aww_60pct_hv", "total_aww"))]]
    if source == "snp":
        return [[("children_total", "children_6m_3y + children_3y_5y + children_5y_6y"),
                 ("sam_total", "sam_6m_3y + sam_3y_5y"), ("suw_total", "suw_6m_3y + suw_3y_6y"),
                 ("sam_suw_total", "sam_suw_6m_3y + sam_suw_3y_5y")],
                [("sam_ratio", safe_ratio("sam_total", "children_total", 3)),
                 ("suw_ratio", safe_ratio("suw_total", "children_total", 3)),
                 ("sam_suw_ratio", safe_ratio("sam_suw_total", "children_total", 3)),
                 ("pw_share_pct", safe_ratio("total_pw", "total_beneficiary")),
                 ("lm_share_pct", safe_ratio("total_lm", "total_beneficiary")),
                 ("ag_share_pct", safe_ratio("total_ag", "total_beneficiary")),
                 ("children_share_pct", safe_ratio("children_total", "total_beneficiary"))]]
    if source == "awc":
        return [[("active_awc_pct", safe_ratio("active_awc", "total_awc")),
                 ("inactive_awc_pct", safe_ratio("inactive_awc", "total_awc")),
                 ("awc_churn_rate", safe_ratio("new_awc_month + inactive_awc_month", "total_awc", 3))],
                [("awc_readiness_score", rnd("active_awc_pct * 0.8::DOUBLE + (1::DOUBLE - inactive_awc_pct) * 0.2::DOUBLE", 3))]]
    raise KeyError(source)


def indicator_ctes(source: str, monthly: bool = False) -> tuple[list[tuple[str, str]], list[str]]:
    """CTEs turning ``src_<source>`` into ``ind_<source>``; returns the CTEs
    and the output column order."""
    names = source_names(source, monthly)
    ctes = []
    prev = f"src_{source}"
    if source == "gm_0_5":
        ctes.append((f"{source}_nr", f"SELECT * FROM {prev} WHERE lower(trim(district)) IS DISTINCT FROM 'total'"))
        prev = f"{source}_nr"
    for i, layer in enumerate(indicator_layers(source, monthly)):
        replace = [(n, e) for n, e in layer if n in names]
        add = [(n, e) for n, e in layer if n not in names]
        sel = "*"
        if replace:
            sel = "* REPLACE (" + ", ".join(f"{e} AS {qi(n)}" for n, e in replace) + ")"
        if add:
            sel += ", " + _sel(add)
        names += [n for n, _ in add]
        name = f"{source}_l{i}"
        ctes.append((name, f"SELECT {sel} FROM {prev}"))
        prev = name
    ctes.append((f"ind_{source}", f"SELECT * REPLACE ({clean_key('district')} AS district) FROM {prev}"))
    return ctes, names


def cube_sql(order: list[str], keys=("district",), monthly: bool = False) -> tuple[str, list[str]]:
    """SELECT list + FROM of the left-join fold with pandas-style suffixes.
    Expects ``ind_<source>`` CTEs to exist. Returns (sql body, columns).
    A source joins on the keys it carries (static sources lack ``month``)."""
    cols: list[tuple[str, str]] = []   # (output name, qualified expr)
    owner: dict[str, int] = {}
    have: dict[str, list[str]] = {}
    for s in order:
        _, names = indicator_ctes(s, monthly)
        have[s] = names
        for c in names:
            if c in keys:
                if s == order[0]:
                    cols.append((c, f"ind_{s}.{qi(c)}"))
                continue
            if c in owner:
                i = owner.pop(c)
                cols[i] = (c + "_x", cols[i][1])
                cols.append((c + "_y", f"ind_{s}.{qi(c)}"))
            else:
                owner[c] = len(cols)
                cols.append((c, f"ind_{s}.{qi(c)}"))
    frm = f"ind_{order[0]}"
    for s in order[1:]:
        on = " AND ".join(f"ind_{order[0]}.{qi(k)} = ind_{s}.{qi(k)}" for k in keys if k in have[s])
        frm += f"\nLEFT JOIN ind_{s} ON {on}"
    sel = ",\n  ".join(f"{e} AS {qi(n)}" for n, e in cols)
    return f"SELECT\n  {sel}\nFROM {frm}", [n for n, _ in cols]


def cube_ctes(order: list[str], monthly: bool = False) -> list[tuple[str, str]]:
    ctes = base_ctes(order, monthly)
    for s in order:
        ctes += indicator_ctes(s, monthly)[0]
    keys = ("month", "district") if monthly else ("district",)
    body, _ = cube_sql(order, keys, monthly)
    ctes.append(("cube", body))
    return ctes
