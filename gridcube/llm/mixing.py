"""Mixing sources to target weights by systematic sampling (DataFrame functions only).

A source's documents are laid out by size and hash. Each occupies its
expected number of copies on a line; one random offset per source shifts the
integer grid, and a document is emitted once per integer boundary it crosses.
Neighbours are of like size, so a source's taken words stay within about one
large document of its target. The prefix sums are built in three bounded
levels (sizes of a source, 1/256 hash slices of a size, documents of a slice),
so a source or size that holds most of the rows is still spread over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridcube.llm.names import by_place, named
from gridcube.operators.inversions import places
from gridcube.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE, CAP, SEED = 1.5, 2.0, "mix"
RUN = 1 << 16                   # equal rows made by one task at a time


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP, seed: str = SEED) -> DataFrame:
    """(source, source_size, target, rate, u) from rows (source, size).

    Weights repeat over the sources in code point order, NULL last. The
    sources share ``share`` times all sizes by weight, none above ``cap``
    times its own size: with sources in the order of cap / weight, the level
    at which the rest can be served evenly is a prefix sum. One row a source,
    so the two global windows see a row per source."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    at = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    per = per.withColumn("w", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), F.pmod(at, F.lit(len(weights))).cast("int") + 1))
    by_cap = Window.orderBy(F.col("source_size") / F.col("w"), F.col("source").asc_nulls_last())
    upto, every = by_cap.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    before = F.coalesce(F.sum("source_size").over(upto), F.lit(0)) * F.lit(float(cap))
    left = F.sum("w").over(every) - F.coalesce(F.sum("w").over(upto), F.lit(0.0))
    per = per.withColumn("level", (F.sum("source_size").over(every) * F.lit(float(share)) - before) / left) \
        .withColumn("most", F.col("source_size") * F.lit(float(cap))).withColumn("nth", F.row_number().over(by_cap))
    fits = F.when(F.col("level") * F.col("w") <= F.col("most"), F.col("nth"))
    per = per.withColumn("level", F.min_by("level", fits).over(every)) \
        .withColumn("target", F.least(F.col("level") * F.col("w"), F.col("most")))
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce("source", F.lit("")))), 1, 5), 16, 10).cast("double")
    return per.select("source", "source_size", "target",
                      F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("rate"),
                      (offset / 1048576.0).alias("u"))


def _text_hash(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def _taken(place: Column) -> Column:
    """Copies of the row at ``place`` on its source's line."""
    return (F.floor(F.col("rate") * (place + 1) + F.col("u")) - F.floor(F.col("rate") * place + F.col("u"))).cast("long")


def plan(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **shape) -> DataFrame:
    """(id, source, size, t, n, r, rate, u, source_size, target): per distinct id,
    source and text (its hash is ``t``) the number of such rows, and the first of
    the ``n`` consecutive places they have on their source's line."""
    text = F.col(f"`{text_col}`")
    rows = materialize(docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").alias("source"),
                                   words(text).alias("size"), _text_hash(text).alias("t")), "mix")
    # rows of one id that differ in their text, such as all of those without an id, lie in different slices
    hashed = F.md5(F.concat(F.coalesce(F.col("id").cast("string"), F.lit("null")), F.lit(":"), "t"))
    each = rows.groupBy("id", "source", "size", "t").agg(F.count("*").alias("n")) \
        .withColumn("h", hashed).withColumn("slice", F.substring("h", 1, 2))
    cells = each.groupBy("source", "size", "slice").agg(F.sum("n").alias("c"))
    in_size = Window.partitionBy("source", "size").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    in_source = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("a", F.coalesce(F.sum("c").over(in_size), F.lit(0)))
    sizes = cells.groupBy("source", "size").agg(F.sum("c").alias("c")) \
        .select(F.col("source").alias("s2"), F.col("size").alias("z2"), F.coalesce(F.sum("c").over(in_source), F.lit(0)).alias("b"))
    goal = targets(rows, **shape).withColumnRenamed("source", "s3")
    start = cells.join(sizes, F.col("source").eqNullSafe(F.col("s2")) & (F.col("size") == F.col("z2"))) \
        .join(goal, F.col("source").eqNullSafe(F.col("s3"))) \
        .select(F.col("source").alias("s4"), F.col("size").alias("z4"), F.col("slice").alias("l4"),
                (F.col("a") + F.col("b")).alias("start"), "source_size", "target", "rate", "u")
    before = Window.partitionBy("source", "size", "slice").orderBy("h", "id").rowsBetween(Window.unboundedPreceding, -1)
    return each.withColumn("nth", F.coalesce(F.sum("n").over(before), F.lit(0))) \
        .join(start, F.col("source").eqNullSafe(F.col("s4")) & (F.col("size") == F.col("z4")) & (F.col("slice") == F.col("l4"))) \
        .select("id", "source", "size", "t", "n", (F.col("nth") + F.col("start")).alias("r"), "rate", "u", "source_size", "target")


def copies(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **shape) -> DataFrame:
    """(id, source, size, source_size, target, copies): one row per row of
    ``docs``. NULL texts have size 0, a NULL source is a source of its own, a NULL id
    is an id. Repeated rows have consecutive places, so their copies differ by one
    at most and together come near their share. Sources without words take
    nothing; an empty table gives no rows."""
    whole = plan(docs, id_col, source_col, text_col, **shape)
    # many equal rows are first cut into runs, so that no task makes all of them
    runs = whole.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), (F.col("n") - 1).cast("long"), F.lit(RUN).cast("long"))))
    each = runs.hint("rebalance").withColumn("i", F.explode(F.sequence(F.col("run"), F.least(F.col("run") + RUN, F.col("n")) - 1)))
    return each.select("id", "source", "size", "source_size", "target", _taken(F.col("r") + F.col("i")).alias("copies"))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **shape) -> DataFrame:
    """``docs`` with every row repeated as often as the mix takes it. NULL ids and
    sources are values of their own and NULL texts have no words, so such rows are
    taken like others of their size; repeated rows each have a place of their own; an
    empty table gives no rows. Other columns may have any name."""
    docs, at = by_place(docs)
    id_col, source_col, text_col = at[id_col], at[source_col], at[text_col]
    whole = materialize(plan(docs, id_col, source_col, text_col, **shape).select(
        F.col("id").alias("__id"), F.col("source").alias("__source"), F.col("size").alias("__size"), F.col("t").alias("__t"), F.col("n").alias("__n"), "r", "rate", "u"), "mix-plan")
    text = F.col(text_col)
    same = F.col(id_col).eqNullSafe(F.col("__id")) & F.col(source_col).eqNullSafe(F.col("__source")) \
        & (_text_hash(text) == F.col("__t")) & (words(text) == F.col("__size"))
    own = list(at.values())
    once = whole.where((F.col("__n") == 1) & (_taken(F.col("r")) > 0))
    taken = docs.join(once, same).select(*own, _taken(F.col("r")).alias("__copies"))
    if whole.where("__n > 1").limit(1).count():
        # rows that are there more than once are numbered along range partitions, however many they are
        rows = docs.join(whole.where("__n > 1"), same).withColumns({"__unit": F.xxhash64("__id", "__source", "__size", "__t"), "__tie": F.monotonically_increasing_id()})
        nth = places(rows, "__unit", [F.col("__tie")], "__i")
        taken = taken.unionByName(nth.select(*own, _taken(F.col("r") + F.col("__i")).alias("__copies")).where("__copies > 0"))
    return taken.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies")))).select(*named(at))
