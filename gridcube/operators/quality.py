"""Data-quality reconciliation (Q1-Q9) as distributed DataFrame jobs.

Every check returns a small report DataFrame; none collects data to the
driver. Per-source checks are built per frame and unioned, so one action
runs them all.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridcube.functions import exprs as X
from gridcube.session import materialize


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def _k(keys):
    return [F.col(f"`{k}`") for k in keys]


def unique_key(frames: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    """Q1: per source, rows, distinct keys and keys that occur more than once."""
    out = []
    for name, df in frames.items():
        g = df.groupBy(*_k(keys)).agg(F.count(F.lit(1)).alias("n"))
        out.append(g.agg(F.sum("n").cast("long").alias("rows"),
                         F.count(F.lit(1)).cast("long").alias("distinct_keys"),
                         F.count(F.when(F.col("n") > 1, F.lit(1))).cast("long").alias("duplicate_keys"))
                   .select(F.lit(name).alias("source"), "*"))
    return _union(out).withColumn("passed", F.col("duplicate_keys") == 0)


def row_preservation(base: DataFrame, joined: DataFrame, name: str = "cube") -> DataFrame:
    """Q2: a left-join fold must keep exactly the base rows. Both counts come
    from one aggregate over a tagged union (no join)."""
    u = (base.select(F.lit(1).alias("__b"), F.lit(0).alias("__r"))
         .unionByName(joined.select(F.lit(0).alias("__b"), F.lit(1).alias("__r"))))
    return (u.agg(F.sum("__b").cast("long").alias("base_rows"), F.sum("__r").cast("long").alias("result_rows"))
            .select(F.lit(name).alias("check"), "base_rows", "result_rows",
                    (F.col("base_rows") == F.col("result_rows")).alias("passed")))


def referential(frames: dict[str, DataFrame], canonical: DataFrame, key: str) -> DataFrame:
    """Q3: per source, keys absent from the canonical key set (anti-join)."""
    canon = canonical.select(F.col(key).alias("__k")).distinct()
    out = []
    for name, df in frames.items():
        keys = df.select(F.col(key).alias("__k")).where(F.col("__k").isNotNull()).distinct()
        orphans = keys.join(canon, "__k", "left_anti")
        out.append(orphans.agg(F.count(F.lit(1)).cast("long").alias("orphan_keys"),
                               F.min("__k").alias("first_orphan"))
                   .select(F.lit(name).alias("source"), "*"))
    return _union(out).withColumn("passed", F.col("orphan_keys") == 0)


def null_blank(frames: dict[str, DataFrame], key: str) -> DataFrame:
    """Q4: NULL keys and blank (whitespace-only) keys per source."""
    out = []
    for name, df in frames.items():
        k = F.col(key)
        out.append(df.agg(F.count(F.when(k.isNull(), F.lit(1))).cast("long").alias("null_keys"),
                          F.count(F.when(k.isNotNull() & (X.strip(k) == ""), F.lit(1))).cast("long").alias("blank_keys"))
                   .select(F.lit(name).alias("source"), "*"))
    return _union(out).withColumn("passed", (F.col("null_keys") == 0) & (F.col("blank_keys") == 0))


def rowcount_reconcile(left: dict[str, DataFrame], right: dict[str, DataFrame],
                       left_name: str = "raw_rows", right_name: str = "clean_rows") -> DataFrame:
    """Q5: row counts per source on both sides, full-joined; a source on
    one side only shows NULL on the other."""
    def counts(frames, col):
        return _union([df.agg(F.count(F.lit(1)).cast("long").alias(col)).select(F.lit(n).alias("source"), col)
                       for n, df in frames.items()])
    j = counts(left, left_name).join(counts(right, right_name), "source", "full")
    return j.withColumn("diff", F.col(left_name) - F.col(right_name)) \
            .withColumn("passed", F.coalesce(F.col("diff") == 0, F.lit(False)))


def coverage_gap(base_keys: DataFrame, frames: dict[str, DataFrame], key: str) -> DataFrame:
    """Q6: per source, base keys with no row in that source (left join +
    null count)."""
    base = base_keys.select(F.col(key).alias("__k")).distinct()
    out = []
    for name, df in frames.items():
        present = df.select(F.col(key).alias("__k"), F.lit(True).alias("__p")).distinct()
        j = base.join(present, "__k", "left")
        out.append(j.agg(F.count(F.lit(1)).cast("long").alias("base_keys"),
                         F.count(F.when(F.col("__p").isNull(), F.lit(1))).cast("long").alias("missing"))
                   .select(F.lit(name).alias("source"), "*"))
    return (_union(out).withColumn("covered", F.col("base_keys") - F.col("missing"))
            .withColumn("passed", F.col("missing") == 0))


TREE_BITS = 8                    # a level of the hash tree splits a key range in 2 ** TREE_BITS
TREE_BUCKETS = 4096              # differing ranges beyond which there is no point in going deeper
LEAF_ROWS = 100_000              # rows of both sides in differing ranges that are compared directly


def _tagged(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of both sides, a with +1 and b with -1, the key's place in the tree
    (its hash) and two hashes of the row."""
    def side(df, tag):
        cols = [F.col(f"`{c}`") for c in a.columns]
        # 0.0 and -0.0 are one value to every comparison
        plain = [F.when(c == 0, F.lit(0.0)).otherwise(c) if df.schema[n].dataType.typeName() in ("double", "float") else c
                 for n, c in zip(a.columns, cols)]
        return df.select(*cols, F.lit(tag).cast("long").alias("__side"), F.xxhash64(F.lit(0), *[F.col(f"`{k}`") for k in keys]).alias("__k"),
                         F.xxhash64(*plain).cast("decimal(20,0)").alias("__h"), F.xxhash64(F.lit("g"), *plain).cast("decimal(20,0)").alias("__g"))
    return side(a, 1).unionByName(side(b, -1))


def tree_diff(a: DataFrame, b: DataFrame, keys: list[str] | None = None) -> tuple[DataFrame, dict]:
    """Q7 by a hash tree: (rows whose number differs, with ``n_a`` and ``n_b``;
    figures of the comparison).

    A range of the key's hash is summed up by order-free multiset hashes (the
    difference of row counts and of the sums of two row hashes). The root is one
    aggregate without a row shuffle, and where it differs only the ranges that
    differ are split further, until few enough rows are left to compare one by one.
    Equal tables, of any size, therefore move no row; of others only the differing
    ranges are shuffled, by whole rows. At most ``TREE_BUCKETS`` ranges reach the driver."""
    keys = list(keys or a.columns)
    if sorted(a.columns) != sorted(b.columns):
        raise ValueError(f"column sets differ: {sorted(set(a.columns) ^ set(b.columns))}")
    u, bits, inside = _tagged(a, b, keys), 0, F.lit(True)
    signed = [F.sum(F.col("__side") * F.col(c)) for c in ("__h", "__g")]
    info = {"levels": 0}
    while True:
        place = F.shiftrightunsigned("__k", 64 - bits) if bits else F.lit(0).cast("long")
        sums = u.where(inside).groupBy(place.alias("at")).agg(F.sum("__side").alias("n"), signed[0].alias("h"), signed[1].alias("g"),
                                                            F.count_if(F.col("__side") > 0).alias("a"), F.count_if(F.col("__side") < 0).alias("b"))
        if not bits:
            root = sums.first()
            info |= {"rows_a": root.a if root else 0, "rows_b": root.b if root else 0}
            differ = [root] if root and (root.n or root.h or root.g) else []
        else:
            differ = sums.where("n <> 0 or h <> 0 or g <> 0").limit(TREE_BUCKETS + 1).collect()
        info["levels"] += 1
        rows = sum(r.a + r.b for r in differ)
        if len(differ) > TREE_BUCKETS:
            break
        inside = place.isin([r.at for r in differ]) if bits else F.lit(bool(differ))
        info |= {"ranges": len(differ), "rows_compared": rows}
        if not differ or rows <= LEAF_ROWS or bits + TREE_BITS > 56:
            break
        if not bits:                             # read more than once from here on
            a, b = materialize(a, "tree-a"), materialize(b, "tree-b")
            u = _tagged(a, b, keys)
        bits += TREE_BITS
    cols = [F.col(f"`{c}`") for c in a.columns]
    each = u.where(inside).groupBy(*cols).agg(F.count_if(F.col("__side") > 0).alias("n_a"), F.count_if(F.col("__side") < 0).alias("n_b"))
    return each.where("n_a <> n_b"), info


def rebuild_match(a: DataFrame, b: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Q7: two builds are equal as multisets of rows and have equal order-free
    content hashes (``tree_diff``): one row of counts and the verdict."""
    rows, info = tree_diff(a, b, keys)
    same = info.get("ranges") == 0
    n = rows.agg(F.coalesce(F.sum(F.greatest(F.col("n_a") - F.col("n_b"), F.lit(0))), F.lit(0)).cast("long").alias("a_minus_b"),
                 F.coalesce(F.sum(F.greatest(F.col("n_b") - F.col("n_a"), F.lit(0))), F.lit(0)).cast("long").alias("b_minus_a"))
    if same:
        n = a.sparkSession.createDataFrame([(0, 0)], "a_minus_b long, b_minus_a long")
    return n.select(F.lit(info["rows_a"]).cast("long").alias("rows_a"), F.lit(info["rows_b"]).cast("long").alias("rows_b"), "a_minus_b", "b_minus_a",
                    F.lit(same).alias("hash_equal"), ((F.col("a_minus_b") == 0) & (F.col("b_minus_a") == 0) & F.lit(same)).alias("passed"))


def tolerance_diff(stored: DataFrame, fresh: DataFrame, keys: list[str],
                   rtol: float = 1e-6, atol: float = 0.0) -> DataFrame:
    """Q8: same columns and keys; numeric columns equal within
    ``|a-b| <= atol + rtol*|b|``, all others equal as text (NULL equals NULL).
    One full join on the keys, unpivoted to (column, wrong, difference) and summed
    up by column before the shuffle, so a row is read once whatever the width:
    (column, mismatches, max_abs_diff, key_only, passed); max_abs_diff is NULL for
    columns that are not numeric."""
    if sorted(stored.columns) != sorted(fresh.columns):
        raise ValueError("column sets differ: "
                         f"{sorted(set(stored.columns) ^ set(fresh.columns))}")
    cols = [f for f in stored.schema.fields if f.name not in keys]
    number = [isinstance(f.dataType, T.NumericType) for f in cols]

    def side(df, tag):
        return df.select(*_k(keys), *[F.col(f"`{f.name}`").cast("double" if n else "string").alias(f"{tag}{i}")
                                      for i, (f, n) in enumerate(zip(cols, number))], F.lit(True).alias(f"__{tag}"))

    j = side(stored, "s").join(side(fresh, "f"), keys, "full")
    both = F.col("__s").isNotNull() & F.col("__f").isNotNull()
    each = []
    for i, n in enumerate(number):
        x, y = F.col(f"s{i}"), F.col(f"f{i}")
        d = F.abs(x - y) if n else F.lit(None).cast("double")
        same = (d <= F.lit(atol) + F.lit(rtol) * F.abs(y)) if n else x == y
        bad = F.when(x.isNull() & y.isNull(), F.lit(False)).when(x.isNull() | y.isNull(), F.lit(True)).otherwise(~same)
        each.append(F.struct((both & bad).alias("bad"), F.when(both, d).alias("d")))
    out = j.select((~both).alias("only"), F.posexplode(F.array(*each)).alias("at", "e")).groupBy("at").agg(
        F.count_if("e.bad").alias("mismatches"), F.max("e.d").alias("d"), F.count_if("only").alias("key_only"))
    names = j.sparkSession.createDataFrame([(i, f.name) for i, f in enumerate(cols)], "at int, column string")
    zero = F.lit(0).cast("long")
    out = names.join(out, "at", "left").select("column", F.coalesce("mismatches", zero).alias("mismatches"), X.rnd("d", 9).alias("max_abs_diff"),
                                               F.coalesce("key_only", zero).alias("key_only"))
    return out.withColumn("passed", (F.col("mismatches") == 0) & (F.col("key_only") == 0))


def rollup_reconcile(df: DataFrame, key: str, columns: list[str], label: str = "total") -> DataFrame:
    """Q9: the rollup row equals the sum of the detail rows, per column."""
    is_total = F.lower(X.strip(F.col(key))) == F.lit(label)
    aggs = []
    for i, c in enumerate(columns):
        aggs += [F.sum(F.when(~is_total | F.col(key).isNull(), F.col(c))).cast("long").alias(f"d{i}"),
                 F.sum(F.when(is_total, F.col(c))).cast("long").alias(f"r{i}")]
    r = df.agg(*aggs)
    each = [F.struct(F.lit(c).alias("column"), F.col(f"d{i}").alias("detail_sum"), F.col(f"r{i}").alias("rollup_value"))
            for i, c in enumerate(columns)]
    out = r.select(F.inline(F.array(*each)))
    return out.withColumn("passed", F.coalesce(F.col("detail_sum") == F.col("rollup_value"), F.lit(False)))
