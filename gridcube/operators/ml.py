"""Models and scoring (K1-K9) with Spark MLlib.

Training frames, splits, metrics and request preparation are DataFrame
expressions; the forest is MLlib's distributed learner. Scoring never drops
rows: rows that cannot be scored get a NULL prediction.
"""

from __future__ import annotations

import math

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridcube.functions import exprs as X
from gridcube.operators.clean import listwise_drop
from gridcube.session import materialize

MIN_TRAINING_ROWS = 10

# Model feature lists, targets and the request-field mapping.
LBW_FEATURES = ["PW_Anaemia_Rate", "Optimum_WG_Latest_%", "PW_Hb_Measured_%", "Measurement_Efficiency",
                "HV_Percentage", "SAM_Rate_%", "SUW_Rate_%"]
LBW_TARGET = "LBW_Rate_%"
STUNTING_FEATURES = ["Measurement_Efficiency", "SAM_Rate_%", "SUW_Rate_%", "Active_AWC_%", "HV_Percentage",
                     "LBW_Rate_%"]
STUNTING_TARGET = "Stunting_Total_%"
REQUEST_FIELDS = {
    "PW_Anaemia_Rate": "PW_Anaemia_Rate",
    "Optimum_WG_Latest_": "Optimum_WG_Latest_%",
    "PW_Hb_Measured_": "PW_Hb_Measured_%",
    "Measurement_Efficiency": "Measurement_Efficiency",
    "HV_Percentage": "HV_Percentage",
    "SAM_Rate_": "SAM_Rate_%",
    "SUW_Rate_": "SUW_Rate_%",
    "Active_AWC_": "Active_AWC_%",
    "LBW_Rate_": "LBW_Rate_%",
}
MODELS = {"lbw": (LBW_FEATURES, LBW_TARGET, "LBW_Predicted"),
          "stunting": (STUNTING_FEATURES, STUNTING_TARGET, "Stunting_Predicted")}


def _c(n: str):
    return F.col(f"`{n}`")


def present_features(df: DataFrame, features: list[str]) -> list[str]:
    """L0: keep only the features the table has."""
    return [f for f in features if f in df.columns]


def train_frame(df: DataFrame, features: list[str], target: str, min_rows: int = MIN_TRAINING_ROWS,
                check: bool = True) -> DataFrame:
    """K1: rows complete on features and target; fewer than ``min_rows`` is an
    error. The guard stops reading once it has seen that many."""
    data = listwise_drop(df, features + [target])
    if check:
        n = data.limit(min_rows).count()
        if n < min_rows:
            raise ValueError(f"{target}: {n} complete rows are too few to fit a model, {min_rows} are required")
    return data


def holdout_flag(key, test_fraction: float = 0.3) -> F.Column:
    """K2: deterministic split, independent of partitioning and order: the
    first 8 hex digits of md5(key) as a fraction of 2^32. A NULL key trains."""
    k = key if not isinstance(key, str) else _c(key)
    h = F.conv(F.substring(F.md5(k.cast("string")), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    return F.coalesce(h < F.lit(test_fraction), F.lit(False))


BIN_BITS = 16


def _digits(df: DataFrame, key: str) -> list[F.Column]:
    """The order of the exact split as 16-bit digits: md5 of the key first, then a
    hash of the whole row, which parts rows that share a key. NULL keys come last."""
    h = F.coalesce(F.md5(_c(key).cast("string")), F.lit("f" * 32))
    row = F.xxhash64(*[_c(c) for c in df.columns])
    return [F.conv(F.substring(h, 1 + 4 * i, 4), 16, 10).cast("int") for i in range(4)] + \
        [F.shiftrightunsigned(row, 48 - 16 * i).bitwiseAND(F.lit((1 << BIN_BITS) - 1)).cast("int") for i in range(4)]


def exact_split(df: DataFrame, key: str, test_fraction: float = 0.3, out: str = "is_test") -> DataFrame:
    """K2 with an exact size: ``ceil(test_fraction * rows)`` rows are test rows,
    those with the smallest md5(key). The place to cut is found as an order
    statistic: a histogram of the hash's first 16 bits, then one of the next 16
    inside the bin that holds the cut, until a bin ends exactly there (two rounds for
    billions of rows). At most 65,536 counts reach the driver a round. The split
    does not depend on partitioning or order; of rows that are wholly alike any may
    be the test rows. An empty table stays empty."""
    digits = [f"__d{i}" for i in range(8)]
    keyed = df.withColumns(dict(zip(digits, _digits(df, key))))
    n = df.count()
    left = math.ceil(round(test_fraction * n, 9))
    test, prefix = F.lit(False), F.lit(True)
    for d in digits:
        if left <= 0:
            break
        seen = 0
        for r in keyed.where(prefix).groupBy(d).count().orderBy(d).collect():
            if seen + r["count"] >= left:
                break
            seen += r["count"]
        else:
            r = None                                     # the fraction covers every row
        test = test | (prefix & ((F.col(d) < r[d]) if r is not None else F.lit(True)))
        if r is None:
            left = 0
        elif seen + r["count"] == left:
            test, left = test | (prefix & (F.col(d) == r[d])), 0
        else:
            prefix, left = prefix & (F.col(d) == r[d]), left - seen
    if left <= 0:
        return keyed.withColumn(out, test).drop(*digits)
    # only rows that are wholly alike are left to part: the first of them by place
    placed = materialize(keyed.withColumns({"__p": F.spark_partition_id(), "__i": F.monotonically_increasing_id()}), "split")
    alike = placed.where(prefix).groupBy("__p").agg(F.count(F.lit(1)).alias("__n"))
    before = alike.select("__p", F.coalesce(F.sum("__n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__b"))
    nth = placed.where(prefix).select("__p", "__i", F.row_number().over(Window.partitionBy("__p").orderBy("__i")).alias("__k")) \
        .join(before, "__p").where(F.col("__b") + F.col("__k") <= left).select("__i", F.lit(True).alias("__t"))
    return placed.join(nth, "__i", "left").withColumn(out, test | F.coalesce("__t", F.lit(False))).drop(*digits, "__p", "__i", "__t")


def rf_pipeline(features: list[str], target: str, num_trees: int = 200, seed: int = 42,
                max_depth: int = 30, max_bins: int = 256, prediction: str = "prediction") -> Pipeline:
    """K3: forest regression with every feature considered at every split
    (``featureSubsetStrategy='all'``), bootstrap rows, deep trees.

    Two limits of the learner are parameters: ``max_depth`` (30 is the largest
    MLlib allows; ``depth_reached`` tells whether a tree ended there) and
    ``max_bins`` (split candidates per continuous feature: features with more
    distinct values are split at quantiles)."""
    asm = VectorAssembler(inputCols=features, outputCol="__features", handleInvalid="keep")
    rf = RandomForestRegressor(featuresCol="__features", labelCol=target, predictionCol=prediction,
                               numTrees=num_trees, seed=seed, maxDepth=max_depth, maxBins=max_bins,
                               featureSubsetStrategy="all", bootstrap=True, subsamplingRate=1.0,
                               minInstancesPerNode=1)
    return Pipeline(stages=[asm, rf])


def depth_reached(model: PipelineModel) -> int:
    """Depth of the deepest fitted tree."""
    return max(t.depth for t in model.stages[-1].trees)


def fit(df: DataFrame, features: list[str], target: str, **kw) -> PipelineModel:
    return rf_pipeline(features, target, **kw).fit(df)


def score(model: PipelineModel, df: DataFrame, features: list[str], out: str, digits: int | None = 2) -> DataFrame:
    """K8: add ``out``; rows with a missing feature get NULL instead of being
    dropped or scored on garbage. Input columns are kept as they are."""
    pred_col = model.stages[-1].getOrDefault("predictionCol")
    scored = model.transform(df).drop("__features")
    ok = None
    for f in features:
        e = _c(f).isNotNull() & ~F.isnan(_c(f).cast("double"))
        ok = e if ok is None else ok & e
    p = F.col(pred_col)
    p = X.rnd(p, digits) if digits is not None else p
    return scored.withColumn(out, F.when(ok, p)).drop(pred_col) if pred_col != out else \
        scored.withColumn(out, F.when(ok, p))


def save_model(model: PipelineModel, path: str) -> None:
    """Persist a fitted pipeline (parent folders are created)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def write_predictions(scored: DataFrame, path: str, run_ts=None, partition_by: str | None = "month") -> None:
    """Append a scoring run to a predictions table. The run timestamp is
    a column (one table for all runs), not part of a file name."""
    ts = F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")
    out = scored.withColumn("run_ts", ts)
    w = out.write.mode("append")
    if partition_by and partition_by in out.columns:
        w = w.partitionBy(partition_by)
    w.parquet(path)


def regression_metrics(df: DataFrame, label: str, prediction: str, group: str | None = None) -> DataFrame:
    """K4: R^2 and MAE in one aggregate (per group if given), over the rows
    where label and prediction are both present; ``n`` counts those."""
    y, p = X.pair_masked(label, prediction)
    aggs = [F.count(y).cast("long").alias("n"),
            (F.lit(1.0) - F.try_divide(F.sum((y - p) * (y - p)), F.var_pop(y) * F.count(y))).alias("r2"),
            F.avg(F.abs(y - p)).alias("mae")]
    g = df.groupBy(_c(group)) if group else df
    out = g.agg(*aggs)
    return out.withColumns({"r2": X.rnd("r2", 6), "mae": X.rnd("mae", 6)})


def feature_importance(spark, model: PipelineModel, features: list[str], name: str) -> DataFrame:
    """K5: importances (sum to 1) sorted descending, as a small table built
    from the fitted model's metadata."""
    imp = model.stages[-1].featureImportances.toArray().tolist()
    rows = sorted(zip(features, imp), key=lambda t: -t[1])
    return spark.createDataFrame([(name, f, float(v), i + 1) for i, (f, v) in enumerate(rows)],
                                 "model string, feature string, importance double, rank long")


def prepare_requests(req: DataFrame, features: list[str], id_col: str = "request_id",
                     mapping: dict[str, str] = REQUEST_FIELDS) -> DataFrame:
    """K9 (no model): map request fields to model features, missing -> 0,
    ``features_used`` = features with a non-zero value, ``features_missing``
    = features whose field was absent (scored as 0), ``status`` says whether
    any mapped field was supplied at all."""
    inv = {feat: fld for fld, feat in mapping.items()}
    vals = {f: F.coalesce(_c(inv[f]).cast("double"), F.lit(0.0)) if inv.get(f) in req.columns
            else F.lit(0.0) for f in features}
    supplied = [(_c(inv[f]).isNotNull()) for f in features if inv.get(f) in req.columns]
    any_supplied = F.lit(False)
    for s in supplied:
        any_supplied = any_supplied | s
    used = F.filter(F.array(*[F.when(vals[f] != 0, F.lit(f)) for f in features]), lambda x: x.isNotNull())
    absent = F.filter(F.array(*[F.when(_c(inv[f]).isNull(), F.lit(f)) if inv.get(f) in req.columns else F.lit(f)
                                for f in features]), lambda x: x.isNotNull())
    return req.select(_c(id_col), *[v.alias(f) for f, v in vals.items()],
                      F.when(any_supplied, F.lit("ok")).otherwise(F.lit("no_valid_features")).alias("status"),
                      used.alias("features_used"), absent.alias("features_missing"))
