"""Monthly-source analogues built from the driver's TPC-H-style tables.

The driver has no health data, so each source is rebuilt as a per-nation
aggregate with the source's canonical columns: nation <-> district,
``yyyy-MM`` of a date <-> month. The indicator, cube, statistics and
quality operators then run on these exactly as on real exports.

Plan shape (the part that matters at scale): fact tables are first reduced
to supplier / customer grain with conditional counts (partial aggregation
happens map-side, so a hot key collapses before the shuffle), and only then
joined to the small dimension tables and rolled up to nation. Sources that
share a fact table read one shared aggregate (``Facts``), materialised once
per job, so a fact table is scanned once however many sources use it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcube.functions import exprs as X

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cnt(cond: str) -> F.Column:
    return F.count(F.when(F.expr(cond), F.lit(1)))


# The conditions that turn TPC-H rows into source counts.
# Used by both the Spark analogues and their SQL oracle.
F_ = "l_linestatus = 'F'"
LINE_FLAGS = {
    "all": "true",
    "meas": F_,
    "st_sev": f"{F_} AND l_returnflag = 'R'",
    "st_mod": f"{F_} AND l_returnflag = 'A'",
    "st_nor": f"{F_} AND l_returnflag = 'N'",
    "uw_sev": f"{F_} AND l_discount >= 0.075",
    "uw_mod": f"{F_} AND l_discount >= 0.035 AND l_discount < 0.075",
    "uw_nor": f"{F_} AND l_discount < 0.035",
    "sam": f"{F_} AND l_tax = 0",
    "mam": f"{F_} AND l_tax > 0 AND l_tax < 0.025",
    "q40": "l_quantity >= 40",
}
EARLY = "year(l_shipdate) < 1998"
ORDER_FLAGS = {
    "o_all": "true",
    "pw_tot": "o_orderpriority IN ('1-URGENT', '2-HIGH')",
    "pw_hb": "o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus IN ('F', 'O')",
    "pw_an": "o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus IN ('F', 'O') AND o_totalprice > 200000",
    "lm_tot": "o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED')",
    "lm_hb": "o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED') AND o_orderstatus = 'F'",
    "lm_an": "o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED') AND o_orderstatus = 'F' AND o_totalprice > 250000",
    "ch_tot": "o_orderpriority = '5-LOW'",
    "ch_hb": "o_orderpriority = '5-LOW' AND o_orderstatus = 'X'",
    "ch_an": "o_orderpriority = '5-LOW' AND o_orderstatus = 'X' AND o_totalprice > 0",
    **{f"due{k}": f"quarter(o_orderdate) = {k}" for k in (1, 2, 3, 4)},
    **{f"done{k}": f"quarter(o_orderdate) = {k} AND o_orderstatus = 'F'" for k in (1, 2, 3, 4)},
    **{f"opt{k}": f"quarter(o_orderdate) = {k} AND o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH')"
       for k in (2, 3, 4)},
    "opt_latest": "o_orderstatus = 'F' AND o_totalprice > 150000",
    "hb_latest": "o_orderstatus IN ('F', 'O')",
    "an_latest": "o_orderstatus IN ('F', 'O') AND o_orderpriority = '1-URGENT'",
}
CUST_FLAGS = {
    "c_all": "true",
    "neg": "c_acctbal < 0",
    "pos": "c_acctbal > 0",
    "nonpos": "c_acctbal <= 0",
    "rich": "c_acctbal > 9000",
    "deep": "c_acctbal < -900",
    "seg_auto": "c_mktsegment = 'AUTOMOBILE'",
    "seg_build": "c_mktsegment = 'BUILDING'",
    "seg_furn": "c_mktsegment = 'FURNITURE'",
    "seg_house": "c_mktsegment = 'HOUSEHOLD'",
    "seg_mach": "c_mktsegment = 'MACHINERY'",
    "sam_a": "c_mktsegment = 'FURNITURE' AND c_acctbal < 0",
    "sam_b": "c_mktsegment = 'HOUSEHOLD' AND c_acctbal < 0",
    "suw_a": "c_mktsegment = 'FURNITURE' AND c_acctbal < 1000",
    "suw_b": "c_mktsegment IN ('HOUSEHOLD', 'MACHINERY') AND c_acctbal < 1000",
    "ss_a": "c_mktsegment = 'FURNITURE' AND c_acctbal < -500",
    "ss_b": "c_mktsegment = 'HOUSEHOLD' AND c_acctbal < -500",
}
AG_FILTER = "s_acctbal > 9000"
AG_FLAGS = {
    "total_ag": "true",
    "ag_measured": "s_acctbal > 9100",
    "ag_severely_thin": "s_acctbal <= 9200",
    "ag_thin": "s_acctbal > 9200 AND s_acctbal <= 9400",
    "ag_normal": "s_acctbal > 9400 AND s_acctbal <= 9700",
    "ag_overweight": "s_acctbal > 9700 AND s_acctbal <= 9900",
    "ag_obese": "s_acctbal > 9900",
    "ag_hb_measured": "s_acctbal > 9050",
    "ag_anaemic": "s_acctbal > 9500",
}


def nations(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("long").alias("nationkey"), "n_name", "n_regionkey")


def ship_month():
    return F.date_format("l_shipdate", "yyyy-MM")


def order_month():
    return F.date_format("o_orderdate", "yyyy-MM")


def within(df, date_col: str, days=None) -> DataFrame:
    """Rows with first <= date < last; plain bounds, so they reach the scan."""
    return df if days is None else df.where((F.col(date_col) >= F.lit(days[0])) & (F.col(date_col) < F.lit(days[1])))


def lines_by_supplier(spark, sf_dir, monthly: bool = False, days=None) -> DataFrame:
    """lineitem reduced to one row per supplier (per ship month if
    ``monthly``), all flags at once."""
    li = within(table(spark, sf_dir, "lineitem"), "l_shipdate", days)
    aggs = [cnt(c).alias(k) for k, c in LINE_FLAGS.items()]
    aggs += [cnt(f"({c}) AND {EARLY}").alias(f"e_{k}") for k, c in LINE_FLAGS.items()]
    aggs += [F.sum(F.col("l_quantity")).cast("long").alias("qty"),
             F.sum(F.when(F.expr(F_), F.col("l_quantity")).otherwise(F.lit(0.0))).cast("long").alias("qty_f")]
    keys = [F.col("l_suppkey").alias("suppkey")] + ([ship_month().alias("month")] if monthly else [])
    return li.groupBy(*keys).agg(*aggs)


def lines_by_nation(spark, sf_dir, monthly: bool = False, days=None) -> DataFrame:
    sup = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("suppkey"), F.col("s_nationkey").cast("long").alias("nationkey"))
    s = lines_by_supplier(spark, sf_dir, monthly, days).join(sup, "suppkey")
    skip = ("suppkey", "nationkey", "month", "qty", "qty_f")
    sums = [F.sum(c).alias(c) for c in s.columns if c not in skip]
    sums += [F.sum("qty").alias("qty"), F.sum("qty_f").alias("qty_f"),
             F.count(F.lit(1)).alias("n_sup"),
             F.count(F.when(F.col("qty_f") * 2 >= F.col("qty"), F.lit(1))).alias("n_sup_half")]
    keys = ["nationkey"] + (["month"] if monthly else [])
    return s.groupBy(*keys).agg(*sums).join(nations(spark, sf_dir), "nationkey")


def orders_by_nation(spark, sf_dir, monthly: bool = False, days=None) -> DataFrame:
    o = within(table(spark, sf_dir, "orders"), "o_orderdate", days)
    cust = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("custkey"), F.col("c_nationkey").cast("long").alias("nationkey"))
    # orders hardly collapse per customer, so they meet the two-column customer map while still narrow
    nkeys = [F.col("nationkey")] + ([order_month().alias("month")] if monthly else [])
    return (o.join(cust, F.col("o_custkey") == F.col("custkey")).groupBy(*nkeys)
            .agg(*[cnt(c).alias(k) for k, c in ORDER_FLAGS.items()]).join(nations(spark, sf_dir), "nationkey"))


def customers_by_nation(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    per_nat = c.groupBy(F.col("c_nationkey").cast("long").alias("nationkey")).agg(
        *[cnt(v).alias(k) for k, v in CUST_FLAGS.items()])
    sup = (table(spark, sf_dir, "supplier")
           .groupBy(F.col("s_nationkey").cast("long").alias("nationkey"))
           .agg(F.count(F.lit(1)).alias("n_suppliers")))
    return (nations(spark, sf_dir).join(per_nat, "nationkey")
            .join(sup, "nationkey", "left")
            .withColumn("n_suppliers", F.coalesce("n_suppliers", F.lit(0)).cast("long")))


FACT_BUILDERS = {"lines": None, "orders": None, "customers": None}   # filled below
SOURCE_FACTS = {"gm_5_6": "lines", "gm_0_5": "lines", "me": "lines", "hv": "lines",
                "anaemia": "orders", "gwg": "orders", "lbw": "customers", "snp": "customers",
                "awc": "customers", "ag": None}
MONTHLY_FACTS = {"lines", "orders"}   # facts with a date; the others are static per entity


class Facts:
    """Per-job holder of the fact aggregates at entity grain.

    Every source that needs lineitem, orders or customer reads the same
    aggregate, so each fact table is scanned and shuffled once per job.
    With ``materialize=True`` the needed aggregates are written together,
    in one job, as one entity-grain table under ``spark.checkpoint.dir``
    (a tagged ``unionByName``); lineage is cut there and every source reads
    the small table. ``monthly`` adds a month key to the dated facts;
    ``days`` (first, last) then limits them to a date range at the scan.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, materialize: bool = False,
                 needs: set[str] | None = None, monthly: bool = False, days=None):
        self.days = days
        self.spark, self.sf_dir, self.materialize, self.monthly = spark, sf_dir, materialize, monthly
        self.needs = set(needs) if needs is not None else {"lines", "orders", "customers"}
        self._memo: dict[str, DataFrame] = {}
        self._wide: DataFrame | None = None
        self._cols: dict[str, list[str]] = {}

    @classmethod
    def for_sources(cls, spark, sf_dir, sources, materialize: bool = True, monthly: bool = False, days=None) -> "Facts":
        needs = {SOURCE_FACTS[s] for s in sources if SOURCE_FACTS.get(s)}
        return cls(spark, sf_dir, materialize, needs, monthly, days)

    def _build(self, name) -> DataFrame:
        if self.monthly and name in MONTHLY_FACTS:
            return FACT_BUILDERS[name](self.spark, self.sf_dir, monthly=True, days=self.days)
        return FACT_BUILDERS[name](self.spark, self.sf_dir)

    def _wide_table(self) -> DataFrame:
        if self._wide is None:
            from gridcube.session import materialize
            parts = []
            for name in sorted(self.needs):
                f = self._build(name)
                self._cols[name] = f.columns
                parts.append(f.withColumn("__fact", F.lit(name)))
            wide = parts[0]
            for p in parts[1:]:
                wide = wide.unionByName(p, allowMissingColumns=True)
            self._wide = materialize(wide, "facts")
        return self._wide

    def _get(self, name):
        if name not in self._memo:
            if self.materialize:
                if self._wide is None:
                    self.needs.add(name)
                elif name not in self.needs:
                    raise KeyError(f"fact {name!r} was not materialized for this job")
                w = self._wide_table()
                df = w.where(F.col("__fact") == name).select(*self._cols[name])
            else:
                df = self._build(name)
            self._memo[name] = df
        return self._memo[name]

    def lines(self) -> DataFrame:
        return self._get("lines")

    def orders(self) -> DataFrame:
        return self._get("orders")

    def customers(self) -> DataFrame:
        return self._get("customers")


def _facts(spark, sf_dir, facts):
    return facts if facts is not None else Facts(spark, sf_dir)


def _mk(g) -> list:
    """The month key, when the fact carries one."""
    return [F.col("month")] if "month" in g.columns else []


def _growth_cols(g, p: str = "", sfx: str = ""):
    """Growth-monitoring export columns from flag counts (prefix p)."""
    m = g[f"{p}meas"]
    cols = [g[f"{p}all"].alias("total_children" + sfx), m.alias("measured_children" + sfx),
            X.pct(g[f"{p}meas"], g[f"{p}all"]).alias("measurement_efficiency" + sfx)]
    for short, name in (("st_sev", "stunted_severe"), ("st_mod", "stunted_moderate"),
                        ("st_nor", "stunted_normal")):
        cols += [g[p + short].alias(f"{name}_n{sfx}"), X.pct(g[p + short], m).alias(f"{name}_pct{sfx}")]
    tail = []
    for short, name in (("uw_sev", "underweight_severe"), ("uw_mod", "underweight_moderate"),
                        ("uw_nor", "underweight_normal")):
        tail += [g[p + short].alias(f"{name}_n{sfx}"), X.pct(g[p + short], m).alias(f"{name}_pct{sfx}")]
    return cols, tail


def src_gm_5_6(spark, sf_dir, facts=None) -> DataFrame:
    g = _facts(spark, sf_dir, facts).lines()
    head, tail = _growth_cols(g)
    return g.select(*_mk(g), F.col("n_name").alias("district"), *head, *tail)


def src_gm_0_5(spark, sf_dir, facts=None) -> DataFrame:
    """Early-shipment band, with a ``Total`` rollup row appended as the
    exports do (``rollup`` on the nation key, label filled in)."""
    li = _facts(spark, sf_dir, facts).lines()
    keys = [f"e_{k}" for k in LINE_FLAGS]
    if "month" in li.columns:
        # one Total row per month: rollup(month, nation) without the grand total
        g = li.rollup("month", "n_name").agg(*[F.sum(k).alias(k) for k in keys]).where(F.col("month").isNotNull())
    else:
        g = li.rollup("n_name").agg(*[F.sum(k).alias(k) for k in keys])
    head, tail = _growth_cols(g, "e_", "_0_5")
    rest, unseen = g["e_meas"] - g["e_sam"] - g["e_mam"], g["e_all"] - g["e_meas"]
    return g.select(*_mk(g), F.coalesce(F.col("n_name"), F.lit("Total")).alias("district"), *head,
                    g["e_sam"].alias("sam_n"), X.pct(g["e_sam"], g["e_meas"]).alias("sam_pct"),
                    g["e_mam"].alias("mam_n"), X.pct(g["e_mam"], g["e_meas"]).alias("mam_pct"),
                    rest.alias("not_wasted_n"), X.pct(rest, g["e_meas"]).alias("not_wasted_pct"),
                    unseen.alias("reference_data_not_found"), *tail,
                    *[c for k, n in (("e_uw_sev", "obese"), ("e_uw_mod", "overweight"), ("e_uw_nor", "not_overweight"))
                      for c in (g[k].alias(f"{n}_n"), X.pct(g[k], g["e_meas"]).alias(f"{n}_pct"))],
                    unseen.alias("reference_data_not_found_2"))


def src_anaemia(spark, sf_dir, facts=None) -> DataFrame:
    g = _facts(spark, sf_dir, facts).orders()
    return g.select(
        *_mk(g), F.concat(F.lit("  "), F.lower("n_name"), F.lit(" ")).alias("district"),
        g.pw_tot.alias("total_pregnant_women"), g.pw_hb.alias("hb_measured_pw"), g.pw_an.alias("anaemic_pw"),
        g.lm_tot.alias("total_lactating_mothers"), g.lm_hb.alias("hb_measured_lm"), g.lm_an.alias("anaemic_lm"),
        g.ch_tot.alias("total_children_6m_5y"), g.ch_hb.alias("hb_measured_child"), g.ch_an.alias("anaemic_child"))


def src_lbw(spark, sf_dir, facts=None) -> DataFrame:
    g = _facts(spark, sf_dir, facts).customers()
    return g.select(F.upper("n_name").alias("district"),
                    g.c_all.alias("total_children_0_6m"), g.neg.alias("lbw_children_0_6m"))


def src_gwg(spark, sf_dir, facts=None) -> DataFrame:
    g = _facts(spark, sf_dir, facts).orders()
    cols = [*_mk(g), F.col("n_name").alias("district"), g.o_all.alias("total_pw")]
    for k in (1, 2, 3, 4):
        cols += [g[f"due{k}"].alias(f"pw_due_anc{k}"), g[f"done{k}"].alias(f"pw_completed_anc{k}")]
        if k > 1:
            cols.append(g[f"opt{k}"].alias(f"pw_optimum_anc{k}"))
    cols += [g.opt_latest.alias("pw_optimum_latest"), g.hb_latest.alias("pw_hb_measured"),
             g.an_latest.alias("pw_anaemic_latest")]
    return g.select(*cols)


def src_ag(spark, sf_dir, facts=None) -> DataFrame:
    s = table(spark, sf_dir, "supplier").filter(F.expr(AG_FILTER))
    g = s.groupBy(F.col("s_nationkey").cast("long").alias("nationkey")).agg(
        *[cnt(c).alias(k) for k, c in AG_FLAGS.items()])
    # the given percentage is text, as in the exports, and no number in one region
    given = F.when(F.col("n_regionkey") == 1, F.lit("NaN")).otherwise(X.pct("ag_measured", "total_ag", 4).cast("string"))
    return g.join(nations(spark, sf_dir), "nationkey").select(
        F.col("n_name").alias("district"), "total_ag", "ag_measured", given.alias("ag_measured_pct"),
        *[k for k in AG_FLAGS if k not in ("total_ag", "ag_measured")])


def src_me(spark, sf_dir, facts=None) -> DataFrame:
    g = _facts(spark, sf_dir, facts).lines()
    return g.select(*_mk(g), F.col("n_name").alias("district"), g["all"].alias("children_total"),
                    g.meas.alias("children_measured"), X.pct(g.meas, g["all"]).alias("children_measured_pct"),
                    g.q40.alias("aww_completed_80pct_me"))


def src_hv(spark, sf_dir, facts=None) -> DataFrame:
    """Home visits: suppliers as workers, quantities as visits. The coverage
    column arrives as text (unparsable for one region) to exercise the
    lenient cast."""
    g = _facts(spark, sf_dir, facts).lines()
    cov = F.when(F.col("n_regionkey") == 0, F.lit("n/a")).otherwise(
        X.rnd(F.try_divide(g.qty_f.cast("double"), g.qty.cast("double")) * F.lit(100.0), 4).cast("string"))
    return g.select(*_mk(g), F.col("n_name").alias("district"), g.n_sup.alias("total_aww"),
                    g.qty.alias("target_visits"), g.qty_f.alias("visits_made"),
                    cov.alias("visit_coverage_pct"), g.n_sup_half.alias("aww_60pct_hv"))


def src_snp(spark, sf_dir, facts=None) -> DataFrame:
    g = _facts(spark, sf_dir, facts).customers()
    return g.select(
        F.col("n_name").alias("district"), g.pos.alias("project"), g.neg.alias("sector"), g.n_suppliers.alias("awc"),
        g.c_all.alias("total_beneficiary"),
        g.seg_auto.alias("total_pw"), g.seg_build.alias("total_lm"),
        g.seg_furn.alias("children_6m_3y"), g.seg_house.alias("children_3y_5y"),
        g.seg_mach.alias("children_5y_6y"), g.sam_a.alias("sam_6m_3y"), g.sam_b.alias("sam_3y_5y"),
        g.suw_a.alias("suw_6m_3y"), g.suw_b.alias("suw_3y_6y"),
        g.ss_a.alias("sam_suw_6m_3y"), g.ss_b.alias("sam_suw_3y_5y"), g.n_suppliers.alias("total_ag"))


def src_awc(spark, sf_dir, facts=None) -> DataFrame:
    g = _facts(spark, sf_dir, facts).customers()
    return g.select(F.col("n_name").alias("district"), g.c_all.alias("total_awc"),
                    g.pos.alias("active_awc"), g.nonpos.alias("inactive_awc"),
                    g.rich.alias("new_awc_month"), g.deep.alias("inactive_awc_month"))


FACT_BUILDERS.update(lines=lines_by_nation, orders=orders_by_nation, customers=customers_by_nation)

SOURCE_BUILDERS = {
    "gm_5_6": src_gm_5_6, "gm_0_5": src_gm_0_5, "anaemia": src_anaemia, "lbw": src_lbw,
    "gwg": src_gwg, "ag": src_ag, "me": src_me, "hv": src_hv, "snp": src_snp, "awc": src_awc,
}
