"""Statistics: top/bottom-n, correlation reports and matrices, rank
correlations (Spearman, Kendall tau-b).

Pearson correlations come from one scan for any number of columns (``gram``);
rank correlations from distinct value pairs with their counts. Nothing is collected.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridcube.functions import exprs as X
from gridcube.operators import inversions
from gridcube.operators.clean import listwise_drop
from gridcube.operators.gram import correlations
from gridcube.session import materialize


def _c(name: str):
    return F.col(f"`{name}`")


# ------------------------------------------------------------------ top-k

def top_n(df: DataFrame, column: str, n: int = 10, tiebreak: list[str] | None = None,
          largest: bool = True) -> DataFrame:
    """The n largest (or smallest) rows by ``column``; NULL and NaN sort
    last, whichever end is asked for; ties broken by ``tiebreak`` ascending. ``orderBy().limit()`` plans as
    TakeOrderedAndProject: per-partition top-n, then one small merge."""
    numeric = dict(df.dtypes).get(column) in ("double", "float")
    v = X.nan_to_null(_c(column)) if numeric else _c(column)
    o = v.desc_nulls_last() if largest else v.asc_nulls_last()
    order = [o] + [_c(t).asc() for t in (tiebreak or [])]
    top = df.orderBy(*order).limit(n)
    # rank within the n kept rows (n is bounded, so a global window is fine)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("long"))


def bottom_n(df: DataFrame, column: str, n: int = 10, tiebreak: list[str] | None = None) -> DataFrame:
    return top_n(df, column, n, tiebreak, largest=False)


def top_bottom_report(df: DataFrame, key: str, metrics: list[str], n: int = 5,
                      by: list[str] | None = None) -> DataFrame:
    """For each metric present in ``df``: (key, value) rows without
    NULLs, top n and bottom n, tagged with metric and side. Missing metrics
    are skipped. With ``by`` (e.g. month) the ranking is per group: a
    ``row_number`` window per (group, metric, side), whose partitions hold
    one group's entities (bounded by the entity domain)."""
    by = list(by or [])
    parts = []
    for m in metrics:
        if m not in df.columns:
            continue
        sub = listwise_drop(df.select(*[_c(b) for b in by], _c(key), _c(m).cast("double").alias("value")),
                            [key, "value"])
        for side, largest in (("top", True), ("bottom", False)):
            if by:
                o = F.col("value").desc_nulls_last() if largest else F.col("value").asc_nulls_last()
                w = Window.partitionBy(*by).orderBy(o, _c(key).asc())
                t = (sub.withColumn("rank", F.row_number().over(w).cast("long"))
                     .where(F.col("rank") <= n))
            else:
                t = top_n(sub, "value", n, [key], largest)
            parts.append(t.select(*by, F.lit(m).alias("metric"), F.lit(side).alias("side"), "rank", _c(key), "value"))
    if not parts:
        return df.select(*[_c(b) for b in by], F.lit("").alias("metric"), F.lit("").alias("side"), F.lit(0).cast("long").alias("rank"),
                         _c(key), F.lit(0.0).alias("value")).limit(0)
    return reduce(lambda a, b: a.unionByName(b), parts)


# ------------------------------------------------------------ correlation

def _pairs(cols: list[str]):
    """(pos_a, pos_b, a, b): upper triangle in input order."""
    return [(i, j, a, b) for i, a in enumerate(cols) for j, b in enumerate(cols) if j > i]


def _mirrored(upper: DataFrame) -> DataFrame:
    """The full matrix from its upper triangle and diagonal."""
    low = upper.where(F.col("pos_a") < F.col("pos_b")).select(
        F.col("indicator_b").alias("indicator_a"), F.col("indicator_a").alias("indicator_b"),
        F.col("pos_b").alias("pos_a"), F.col("pos_a").alias("pos_b"), "correlation", "n_rows")
    return upper.unionByName(low)


def corr_pairs_listwise(df: DataFrame, columns: list[str], digits: int | None = 6,
                        by: list[str] | None = None) -> DataFrame:
    """Drop rows with a NULL in any listed column (a missing column is an
    error), then Pearson r for each pair of the upper triangle in input
    order; ``n_rows`` shows how many rows survived. ``by`` gives one report
    per group (e.g. per month of a month-keyed cube) in the same single pass."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}")
    by = list(by or [])
    sub = listwise_drop(df.select(*[_c(k) for k in by], *[_c(c).cast("double").alias(c) for c in columns]), columns)
    return correlations(sub, columns, by, digits).where("pos_a < pos_b")


def corr_strongest(pairs_df: DataFrame, top: int = 10) -> DataFrame:
    """Pairs ranked by |r| (stable on input order), with direction and
    the 3-decimal display value."""
    ranked = top_n(pairs_df.withColumn("abs_r", F.abs("correlation")), "abs_r", top, ["pos_a", "pos_b"])
    return ranked.select("rank", "indicator_a", "indicator_b", "correlation",
                         X.rnd("correlation", 3).alias("correlation_3dp"),
                         F.when(F.col("correlation") > 0, F.lit("positive")).otherwise(F.lit("negative")).alias("direction"))


def corr_matrix_pairwise(df: DataFrame, columns: list[str], digits: int | None = 6) -> DataFrame:
    """Full matrix over the listed columns that exist (at least two),
    pairwise deletion: each pair uses the rows where both are present."""
    cols = [c for c in columns if c in df.columns]
    if len(cols) < 2:
        raise ValueError("need at least two existing columns for a correlation matrix")
    return _mirrored(correlations(df, cols, digits=digits))


def corr_matrix_rounded(df: DataFrame, columns: list[str]) -> DataFrame:
    """The pairwise matrix rounded to 3 decimals (half to even)."""
    return corr_matrix_pairwise(df, columns, digits=3)


def to_square(long_df: DataFrame, columns: list[str]) -> DataFrame:
    """Square form of a long matrix: one row per indicator, one column per
    indicator (pivot with explicit values, so no extra pass to find them)."""
    return (long_df.groupBy("indicator_a", "pos_a").pivot("indicator_b", columns)
            .agg(F.first("correlation")).orderBy("pos_a").drop("pos_a"))


# ------------------------------------------------------------ rank corr.

def average_rank(values: DataFrame, column: str, weight: str | None = None, by: list[str] | None = None) -> DataFrame:
    """Average (1-based) rank of every distinct non-null value of ``column``
    within each ``by`` group: ``#values below + (ties + 1) / 2``, counting
    each row once (or ``weight`` times). Returns (*by, value, n, avg_rank).

    Values are counted first (a hot value is one row after the partial
    aggregate), then range-partitioned by (group, value) and written with their
    partition number. Running counts are windows per (group, partition), and a
    partition's offset is a prefix sum over the partitions' totals, so the work
    spreads over as many tasks as the shuffle has, whatever the size of a group.
    """
    by = list(by or [])
    wcol = F.col(weight) if weight else F.lit(1)
    vc = (values.where(_c(column).isNotNull())
          .groupBy(*by, _c(column).cast("double").alias("value")).agg(F.sum(wcol).cast("long").alias("n")))
    t = materialize(vc.repartitionByRange(*by, "value").withColumn("__p", F.spark_partition_id()), "ranks")
    before = Window.partitionBy(*by).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    parts = t.groupBy(*by, "__p").agg(F.sum("n").alias("__n")) \
        .select(*by, "__p", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__o"))
    w = Window.partitionBy(*by, "__p").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return t.withColumn("__c", F.sum("n").over(w)).join(parts, [*by, "__p"]).select(
        *by, "value", "n", (F.col("__o") + F.col("__c") - F.col("n") + (F.col("n") + F.lit(1)) / F.lit(2.0)).alias("avg_rank"))


def _pair_cells(df: DataFrame, pairs) -> DataFrame:
    """One pass over the input for all pairs: every row yields one
    (pair, x, y) record per pair where both are present, grouped to distinct
    cells with counts (partial aggregation map-side: hot cells collapse)."""
    recs = F.explode(F.array(*[
        F.struct(F.lit(k).cast("long").alias("pair"), _c(a).cast("double").alias("x"),
                 _c(b).cast("double").alias("y"))
        for k, (_, _, a, b) in enumerate(pairs)])).alias("r")
    long = df.select(recs).select("r.*")
    ok = F.col("x").isNotNull() & F.col("y").isNotNull() & ~F.isnan("x") & ~F.isnan("y")
    return long.where(ok).groupBy("pair", "x", "y").agg(F.count(F.lit(1)).alias("c"))


def _pair_names(df: DataFrame, pairs) -> DataFrame:
    return df.sparkSession.createDataFrame([(k, a, b) for k, (_, _, a, b) in enumerate(pairs)],
                                           "pair long, indicator_a string, indicator_b string")


def rank_matrix(df: DataFrame, columns: list[str], method: str = "spearman", digits: int = 2) -> DataFrame:
    """The full rounded Spearman or Kendall matrix in long form, with the
    diagonal: 1 where a column has two different values, else NULL."""
    fn = {"spearman": corr_spearman, "kendall": corr_kendall}[method]
    cols = [c for c in columns if c in df.columns]
    at = F.create_map(*[x for i, c in enumerate(cols) for x in (F.lit(c), F.lit(i).cast("long"))])
    upper = fn(df, cols, None).withColumns({"pos_a": at[F.col("indicator_a")], "pos_b": at[F.col("indicator_b")]})
    own = correlations(df, cols, digits=None).where("pos_a = pos_b")
    return _mirrored(upper.unionByName(own)).withColumn("correlation", X.rnd("correlation", digits))


def _finish(df: DataFrame, pairs, res: DataFrame, digits: int | None) -> DataFrame:
    out = _pair_names(df, pairs).join(res, "pair", "left")
    r = X.rnd("correlation", digits) if digits is not None else F.col("correlation")
    return out.select("indicator_a", "indicator_b", r.alias("correlation"),
                      F.coalesce(F.col("n_rows"), F.lit(0)).cast("long").alias("n_rows"))


def corr_spearman(df: DataFrame, columns: list[str], digits: int | None = 6) -> DataFrame:
    """Spearman rho for every pair (upper triangle): Pearson r of
    average ranks, ranks taken per pair on the rows where both are present
    (pairwise deletion).

    All pairs are handled together: one scan builds the (pair, x, y) cells,
    which are written once (they feed four consumers); ranks are computed
    per pair with the grouped ``average_rank``; the mean average rank is
    exactly (n + 1) / 2, so the weighted sums are centred on it."""
    pairs = _pairs(columns)
    cells = materialize(_pair_cells(df, pairs), "spearman-cells")
    rx = average_rank(cells, "x", weight="c", by=["pair"]).select(
        "pair", F.col("value").alias("x"), F.col("avg_rank").alias("rx"))
    ry = average_rank(cells, "y", weight="c", by=["pair"]).select(
        "pair", F.col("value").alias("y"), F.col("avg_rank").alias("ry"))
    n = cells.groupBy("pair").agg(F.sum("c").cast("double").alias("__n"))
    mid = (F.col("__n") + F.lit(1.0)) / F.lit(2.0)
    j = (cells.join(rx, ["pair", "x"]).join(ry, ["pair", "y"]).join(n, "pair")
         .select("pair", "c", (F.col("rx") - mid).alias("u"), (F.col("ry") - mid).alias("v")))
    c, u, v = F.col("c"), F.col("u"), F.col("v")
    res = j.groupBy("pair").agg(F.try_divide(F.sum(c * u * v), F.sqrt(F.sum(c * u * u) * F.sum(c * v * v)))
                                .alias("correlation"), F.sum(c).alias("n_rows"))
    return _finish(df, pairs, res, digits)


def spearman_pair(df: DataFrame, a: str, b: str) -> DataFrame:
    return corr_spearman(df, [a, b], None).select("correlation", "n_rows")


def corr_kendall(df: DataFrame, columns: list[str], digits: int | None = 6) -> DataFrame:
    """Kendall tau-b for every pair, exactly, without enumerating pairs.

    Rows are reduced to distinct cells (pair, x, y, c) in one scan; concordant
    pairs P of cells are counted by a merge tree (``inversions``). Ties enter
    through n1 (x), n2 (y) and n3 (joint): S = 2P - n0 + n1 + n2 - n3,
    tau_b = S / sqrt((n0 - n1)(n0 - n2)).
    """
    pairs = _pairs(columns)
    cells = materialize(_pair_cells(df, pairs), "kendall-cells")
    big = inversions.BIG
    conc = inversions.concordant(cells)

    def pairs_of(col):
        return (col.cast(big) * (col - 1)) / 2

    tx = (cells.groupBy("pair", "x").agg(F.sum("c").alias("t"))
          .groupBy("pair").agg(F.sum(pairs_of(F.col("t"))).alias("n1")))
    ty = (cells.groupBy("pair", "y").agg(F.sum("c").alias("t"))
          .groupBy("pair").agg(F.sum(pairs_of(F.col("t"))).alias("n2")))
    tot = cells.groupBy("pair").agg(F.sum("c").alias("n"), F.sum(pairs_of(F.col("c"))).alias("n3"))
    j = tot.join(tx, "pair").join(ty, "pair").join(conc, "pair", "left")
    d = lambda name: F.col(name).cast("double")
    n = d("n")
    n0 = n * (n - F.lit(1.0)) / F.lit(2.0)
    s = F.lit(2.0) * F.coalesce(d("p"), F.lit(0.0)) - n0 + d("n1") + d("n2") - d("n3")
    den = (n0 - d("n1")) * (n0 - d("n2"))
    res = j.select("pair", F.when(den > 0, F.try_divide(s, F.sqrt(den))).alias("correlation"),
                   F.col("n").alias("n_rows"))
    return _finish(df, pairs, res, digits)


def kendall_pair(df: DataFrame, a: str, b: str) -> DataFrame:
    return corr_kendall(df, [a, b], None).select("correlation", "n_rows")
