"""Queries: header contracts, row cleaning and scalar indicator expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridcube.functions import exprs as X
from gridcube.functions import headers as H
from gridcube.operators import clean as CL
from gridcube.operators import indicators as I
from gridcube.plans import analogues as A
from gridcube.plans import sqlgen as G
from gridcube.plans.catalog import register

# ------------------------------------------------------------ row cleaning

RAW_CUSTOMER_HEADERS = [" C Custkey", "C  Name", "C Nationkey ", "C Acctbal", "C   Mktsegment"]


def _padded_customers(spark, sf_dir):
    c = A.table(spark, sf_dir, "customer")
    padded = c.select("c_custkey", F.concat(F.lit("  "), F.col("c_name"), F.lit("\u00a0 ")).alias("c_name"),
                      "c_nationkey", "c_acctbal", F.concat(F.lit("\r\n"), F.col("c_mktsegment"), F.lit("\t")).alias("c_mktsegment"))
    both = c.unionByName(padded)
    return both.toDF(*RAW_CUSTOMER_HEADERS)


@register("basic_clean", """
SELECT DISTINCT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment AS c__mktsegment
FROM (SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
      UNION ALL
      SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer)
""")
def q_basic_clean(spark, sf_dir):
    """Raw headers (padding, doubled spaces) are normalised; strings lose
    spaces, tabs, line ends and no-break spaces at both ends, so the padded
    copies equal their originals and collapse. Three spaces in a header
    normalise to ``c__mktsegment``."""
    return CL.basic_clean(_padded_customers(spark, sf_dir))


# Keys as they come from exports: padding of every kind, en dashes, doubled spaces, quotes.
_DIRTY = {0: ("", ""), 1: ("\t", " \n"), 2: ("\u00a0", "\u2003"), 3: ("  ", " – east"), 4: ("o'", "  (x)"), 5: ("TOTAL  ", "\t")}


def dirty(column: str, key: str) -> str:
    """SQL (either engine) for a text column with the quirks above by key % 6."""
    cases = " ".join("WHEN {} THEN concat('{}', {}, '{}')".format(k, a.replace("'", "''"), column, b.replace("'", "''")) for k, (a, b) in _DIRTY.items())
    return f"CASE {key} % 6 {cases} END"


@register("clean_key", f"SELECT p_partkey, {G.clean_key(dirty('p_name', 'p_partkey'))} AS key FROM part")
def q_clean_key(spark, sf_dir):
    p = A.table(spark, sf_dir, "part").select("p_partkey", F.expr(dirty("p_name", "p_partkey")).alias("raw"))
    return p.select("p_partkey", X.clean_key("raw").alias("key"))


# Codes built by string concatenation (no arithmetic, so no overflow at any key size):
# negative balances get a sign, rich customers a code longer than the pad width.
_CODE_IN = ("CASE WHEN c_acctbal < 0 THEN '-' || CAST(c_custkey AS STRING) "
            "WHEN c_acctbal > 9000 THEN CAST(c_custkey AS STRING) || '000000000007' "
            "ELSE CAST(c_custkey AS STRING) END")


@register("zfill_code", f"SELECT c_custkey, {G.zfill(f'({_CODE_IN})')} AS code FROM customer")
def q_zfill_code(spark, sf_dir):
    c = A.table(spark, sf_dir, "customer").select("c_custkey", F.expr(_CODE_IN).alias("code"))
    return CL.zfill_code(c, "code", 11)


def _docs_labels(spark, sf_dir):
    d = A.table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    lab = A.table(spark, sf_dir, "labels").select(
        "doc_id", F.col("quality").cast("long").alias("quality"), F.col("toxic").cast("long").alias("toxic"))
    return d.join(lab, "doc_id", "left")


@register("fill_zero", """
SELECT d.doc_id, d.n_chars, CAST(coalesce(l.quality, 0) AS BIGINT) AS quality,
       CAST(coalesce(l.toxic, 0) AS BIGINT) AS toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def q_fill_zero(spark, sf_dir):
    return CL.fill_zero(_docs_labels(spark, sf_dir))


_MASK = "CASE WHEN event_type = 'error' THEN NULL ELSE value END"


@register("fill_forward", f"""
SELECT event_id, user_id, ({_MASK}) AS value_raw,
       last_value(({_MASK}) IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value_filled
FROM events
""")
def q_fill_forward(spark, sf_dir):
    """Errors lose their value; each user's last known value is carried
    forward in (ts, event_id) order; a user with a third of all events is
    still spread over many tasks."""
    e = A.table(spark, sf_dir, "events").select(
        "event_id", "user_id", "ts", F.expr(_MASK).alias("value_raw"))
    out = CL.fill_forward(e.withColumn("value_filled", F.col("value_raw")), ["value_filled"],
                          ["user_id"], ["ts", "event_id"])
    return out.drop("ts")


@register("lenient_numeric", f"""
SELECT event_id, {G.lenient("json_extract_string(props, '$.k')")} AS k_value,
       {G.lenient('event_type')} AS type_value
FROM events
""")
def q_lenient_numeric(spark, sf_dir):
    e = A.table(spark, sf_dir, "events").select(
        "event_id", F.get_json_object("props", "$.k").alias("k_value"), F.col("event_type").alias("type_value"))
    return CL.lenient_numeric(CL.lenient_numeric(e, "k_value"), "type_value")


@register("listwise_drop", """
SELECT d.doc_id, d.n_chars, CAST(l.quality AS BIGINT) AS quality
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NOT NULL
""")
def q_listwise_drop(spark, sf_dir):
    return CL.listwise_drop(_docs_labels(spark, sf_dir).drop("toxic"), ["doc_id", "n_chars", "quality"])


# ------------------------------------------------- scalar indicator exprs

def _counts(spark, sf_dir):
    """Per-nation customer counts; some denominators are zero by design."""
    g = A.customers_by_nation(spark, sf_dir)
    return g.select(F.col("n_name").alias("key"), g.neg.alias("a"), g.rich.alias("b"),
                    g.deep.alias("z"), g.c_all.alias("total"), g.pos.alias("active"), g.nonpos.alias("inactive"))


_COUNTS_SQL = G.with_clause(G._cust_ctes() + [(
    "cnt", "SELECT n_name AS key, neg AS a, rich AS b, deep AS z, c_all AS total, pos AS active, "
           "nonpos AS inactive FROM cust_nat")])


@register("safe_ratio", _COUNTS_SQL + f"""
SELECT key, a, z, {G.safe_ratio('a', 'total')} AS a_share, {G.safe_ratio('a', 'z')} AS a_per_z,
       {G.safe_ratio('b', 'total', 3)} AS b_share3
FROM cnt""")
def q_safe_ratio(spark, sf_dir):
    c = _counts(spark, sf_dir)
    return c.select("key", "a", "z", X.safe_ratio("a", "total").alias("a_share"),
                    X.safe_ratio("a", "z").alias("a_per_z"), X.safe_ratio("b", "total", 3).alias("b_share3"))


_INF_SQL = _COUNTS_SQL + f""",
pairs AS (SELECT key, a AS num, z AS den FROM cnt
          UNION ALL SELECT key || '/zero', z - z AS num, z - z AS den FROM cnt
          UNION ALL SELECT key || '/neg', -a AS num, z - z AS den FROM cnt)
SELECT key, num, den, {G.inf0('num', 'den')} AS ratio FROM pairs"""


@register("ratio_inf_to_zero", _INF_SQL)
def q_ratio_inf_to_zero(spark, sf_dir):
    c = _counts(spark, sf_dir)
    zero = F.col("z") - F.col("z")
    pairs = (c.select("key", F.col("a").alias("num"), F.col("z").alias("den"))
             .unionByName(c.select(F.concat("key", F.lit("/zero")).alias("key"), zero.alias("num"), zero.alias("den")))
             .unionByName(c.select(F.concat("key", F.lit("/neg")).alias("key"), (-F.col("a")).alias("num"),
                                   zero.alias("den"))))
    return pairs.select("key", "num", "den", X.ratio_inf_to_zero("num", "den").alias("ratio"))


@register("round_half_even", _COUNTS_SQL + f"""
SELECT key, CAST(a AS DOUBLE) / 8 AS x, {G.rnd('CAST(a AS DOUBLE) / 8', 2)} AS x2,
       {G.rnd('CAST(total AS DOUBLE) / 16', 3)} AS y3, {G.rnd('CAST(b AS DOUBLE) / 8', 0)} AS w0
FROM cnt""")
def q_round_half_even(spark, sf_dir):
    """count/8 and count/16 land on exact binary ties (x.xx5): half-to-even."""
    c = _counts(spark, sf_dir)
    x = F.col("a").cast("double") / F.lit(8.0)
    return c.select("key", x.alias("x"), X.rnd(x, 2).alias("x2"),
                    X.rnd(F.col("total").cast("double") / F.lit(16.0), 3).alias("y3"),
                    X.rnd(F.col("b").cast("double") / F.lit(8.0), 0).alias("w0"))


@register("coverage_pct", _COUNTS_SQL + f"""
SELECT key, {G.pct('active', 'total')} AS active_pct, {G.pct('a', 'z')} AS a_over_z_pct FROM cnt""")
def q_coverage_pct(spark, sf_dir):
    c = _counts(spark, sf_dir)
    return c.select("key", X.pct("active", "total").alias("active_pct"), X.pct("a", "z").alias("a_over_z_pct"))


@register("sum_of_parts", G.with_clause(G.base_ctes(["ag", "snp"]) + [
    ("j", "SELECT s.district, s.total_pw, s.total_lm, a.total_ag AS ag_total "
          "FROM src_snp s LEFT JOIN src_ag a ON s.district = a.district")]) + f"""
SELECT district, total_pw + total_lm AS pw_lm, {G.rnd(f"{G.pct('total_pw', 'total_lm')} + {G.pct('total_lm', 'total_pw')}")} AS pct_sum,
       coalesce(ag_total, 0) + coalesce(total_pw, 0) AS ag_pw_tolerant, ag_total + total_pw AS ag_pw_strict
FROM j""")
def q_sum_of_parts(spark, sf_dir):
    """Plain sum (NULL propagates) vs null-tolerant sum over a
    left join whose right side covers only some nations."""
    s = A.src_snp(spark, sf_dir).select("district", "total_pw", "total_lm")
    a = A.src_ag(spark, sf_dir).select("district", F.col("total_ag").alias("ag_total"))
    j = s.join(a, "district", "left")
    return j.select("district", X.sum_of_parts("total_pw", "total_lm").alias("pw_lm"),
                    X.sum_of_parts(X.pct("total_pw", "total_lm"), X.pct("total_lm", "total_pw"), n=2).alias("pct_sum"),
                    X.sum_of_parts("ag_total", "total_pw", null_as_zero=True).alias("ag_pw_tolerant"),
                    X.sum_of_parts("ag_total", "total_pw").alias("ag_pw_strict"))


@register("share_of_total", _COUNTS_SQL + f"""
SELECT key, a, coalesce({G.rnd("CAST(a AS DOUBLE) / NULLIF((SELECT sum(CAST(a AS DOUBLE)) FROM cnt), 0)")}, 0.0) AS a_share,
       coalesce({G.rnd("CAST(z - z AS DOUBLE) / NULLIF((SELECT sum(CAST(z - z AS DOUBLE)) FROM cnt), 0)")}, 0.0) AS zero_share
FROM cnt""")
def q_share_of_total(spark, sf_dir):
    c = _counts(spark, sf_dir).withColumn("zz", F.col("z") - F.col("z"))
    c = I.share_of_total(c, "a", "a_share")
    c = I.share_of_total(c, "zz", "zero_share")
    return c.select("key", "a", "a_share", "zero_share")


@register("readiness_score", _COUNTS_SQL + f""",
r AS (SELECT key, {G.safe_ratio('active', 'total')} AS act, {G.safe_ratio('inactive', 'total')} AS inact FROM cnt)
SELECT key, act, inact, {G.rnd("act * 0.8::DOUBLE + (1::DOUBLE - inact) * 0.2::DOUBLE", 3)} AS score FROM r""")
def q_readiness_score(spark, sf_dir):
    c = _counts(spark, sf_dir).select("key", X.safe_ratio("active", "total").alias("act"),
                                      X.safe_ratio("inactive", "total").alias("inact"))
    return c.withColumn("score", X.weighted_score("act", "inact"))


# ------------------------------------------------------- header contracts

_RAW_HEADER_SQL = ("' ' || upper(p_type) || ' (%) ' || " + G.title("p_name") +
                   " || '  -  No. ' || p_brand")



@register("normalize_headers", "SELECT p_partkey, " + ", ".join(
    f"{G.normalize_header(_RAW_HEADER_SQL, v)} AS h_{v}" for v in H.VARIANTS) + " FROM part")
def q_normalize_headers(spark, sf_dir):
    """Header normalisation as a string-column rule, run over header-like
    text built from part rows (the same rule the scan applies to headers)."""
    p = A.table(spark, sf_dir, "part")
    raw = F.concat(F.lit(" "), F.upper("p_type"), F.lit(" (%) "), X.py_title("p_name"),
                   F.lit("  -  No. "), F.col("p_brand"))
    h = p.select("p_partkey", raw.alias("raw"))
    return h.select("p_partkey", *[H.normalize_col("raw", v).alias(f"h_{v}") for v in H.VARIANTS])


@register("normalize_headers_strict", f"""
SELECT p_partkey, lower(regexp_replace(replace(trim({_RAW_HEADER_SQL}), ' ', '_'), '[^A-Za-z0-9_]', '', 'g')) AS h_strict FROM part""")
def q_normalize_headers_strict(spark, sf_dir):
    """The strict variant: everything but letters, digits and _ goes, no
    doubled _ is collapsed."""
    p = A.table(spark, sf_dir, "part")
    raw = F.concat(F.lit(" "), F.upper("p_type"), F.lit(" (%) "), X.py_title("p_name"), F.lit("  -  No. "), F.col("p_brand"))
    return p.select("p_partkey", H.strict_col(raw).alias("h_strict"))


@register("number_headers", """
SELECT o_custkey, o_orderkey, h AS header, CASE WHEN trim(coalesce(h, '')) = '' THEN concat('Unnamed: ', i) WHEN k = 0 THEN h ELSE concat(h, '.', k) END AS label
FROM (SELECT o_custkey, o_orderkey, h, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS i,
             row_number() OVER (PARTITION BY o_custkey, h ORDER BY o_orderkey) - 1 AS k
      FROM (SELECT o_custkey, o_orderkey, CASE WHEN o_orderpriority LIKE '5%' THEN ' ' ELSE o_orderpriority END AS h FROM orders))""")
def q_number_headers(spark, sf_dir):
    """Repeated and blank headers of many files (here a customer's orders are a
    file's columns) are numbered as one reader would label them."""
    o = A.table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.when(F.col("o_orderpriority").startswith("5"), " ")
                                                .otherwise(F.col("o_orderpriority")).alias("header"))
    return H.number_duplicates_by(o, "o_custkey", "o_orderkey", "header")


@register("fill_unknown", "SELECT d.doc_id, d.n_chars, CAST(l.quality AS BIGINT) AS quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def q_fill_unknown(spark, sf_dir):
    """A fill strategy that is not known leaves the table as it is."""
    return CL.fill_missing(_docs_labels(spark, sf_dir).drop("toxic"), "median")
