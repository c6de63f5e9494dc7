"""Connected components by alternating large-star and small-star steps.

Each round is two aggregations and two joins over the edge list, written to
the shared checkpoint folder, so lineage stays short and a lost executor
costs one round at most. No group is ever gathered: a hub's edges meet only
its minimum (map-side aggregated), and the join on a hub is one AQE can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcube.session import cleanup, mark, materialize


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node that has an edge to another node; root is
    the smallest node of its component. Edges with a NULL end and self loops
    are ignored, direction and repeats do not matter; no edges give no rows."""
    x, y, spark, start = F.col(a), F.col(b), edges.sparkSession, mark()
    e = materialize(edges.where(x.isNotNull() & y.isNotNull() & (x != y))
                    .select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct(), "cc")
    seen = None
    while True:
        state = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state[0] == 0 or state == seen:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")) \
                .union(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        seen = state
        e = materialize(_small_star(_large_star(e)), "cc")
        cleanup(spark, start, keep=[e])          # the round before it
