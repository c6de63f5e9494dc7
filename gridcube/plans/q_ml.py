"""Queries: training frames, splits, metrics, forests and scoring."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import functions as F

from gridcube.functions import exprs as X
from gridcube.operators import ml as ML
from gridcube.plans import analogues as A
from gridcube.plans import sqlgen as G
from gridcube.plans.catalog import register
from gridcube.plans.q_stats import WITH_LEGACY, legacy
from gridcube.session import scratch_path

LI_FEATURES = ["l_quantity", "l_discount", "l_tax", "p_size", "p_retailprice"]
LI_TARGET = "l_extendedprice"


def lines_with_parts(spark, sf_dir):
    li = A.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity",
                                                   "l_discount", "l_tax", "l_extendedprice")
    p = A.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"),
                                              F.col("p_size").cast("long").alias("p_size"), "p_retailprice")
    return li.join(p, "l_partkey", "left").drop("l_partkey")


_LP_SQL = ("(SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax, l_extendedprice, "
           "CAST(p_size AS BIGINT) AS p_size, p_retailprice FROM lineitem LEFT JOIN part ON l_partkey = p_partkey) lp")


@register("train_frame", f"SELECT * FROM {_LP_SQL} WHERE " +
          " AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" if c not in ("p_size",) else f"{c} IS NOT NULL"
                       for c in LI_FEATURES + [LI_TARGET]))
def q_train_frame(spark, sf_dir):
    df = lines_with_parts(spark, sf_dir)
    feats = ML.present_features(df, LI_FEATURES + ["not_a_feature"])
    return ML.train_frame(df, feats, LI_TARGET)


_HOLD_SQL = "(CAST(('0x' || substr(md5(CAST({k} AS VARCHAR)), 1, 8)) AS UBIGINT)::DOUBLE / 4294967296.0 < 0.3)"


@register("holdout_split", f"SELECT o_orderkey, {_HOLD_SQL.format(k='o_orderkey')} AS is_test FROM orders")
def q_holdout_split(spark, sf_dir):
    o = A.table(spark, sf_dir, "orders").select("o_orderkey")
    return o.withColumn("is_test", ML.holdout_flag("o_orderkey"))


@register("regression_metrics", f"""
SELECT CASE WHEN {_HOLD_SQL.format(k='l_orderkey')} THEN 'test' ELSE 'train' END AS split,
       CAST(count(*) AS BIGINT) AS n,
       {G.rnd("1.0 - sum((l_extendedprice - pred) * (l_extendedprice - pred)) / NULLIF(var_pop(l_extendedprice) * count(*), 0)", 6)} AS r2,
       {G.rnd("avg(abs(l_extendedprice - pred))", 6)} AS mae
FROM (SELECT *, l_quantity * p_retailprice AS pred FROM {_LP_SQL}) t GROUP BY 1""")
def q_regression_metrics(spark, sf_dir):
    """A fixed predictor (quantity x list price) evaluated per split; splits
    are by order so all lines of an order fall on the same side."""
    df = lines_with_parts(spark, sf_dir).withColumns({
        "pred": F.col("l_quantity") * F.col("p_retailprice"),
        "split": F.when(ML.holdout_flag("l_orderkey"), F.lit("test")).otherwise(F.lit("train"))})
    return ML.regression_metrics(df, LI_TARGET, "pred", "split")


@register("holdout_exact", """
SELECT o_orderkey, row_number() OVER (ORDER BY md5(CAST(o_orderkey AS VARCHAR))) <= ceil(0.3 * count(*) OVER ()) AS is_test FROM orders""")
def q_holdout_exact(spark, sf_dir):
    """The split with exactly ceil(0.3 n) test rows."""
    return ML.exact_split(A.table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey")


_fitted: dict[tuple, dict] = {}


def _once(spark, sf_dir, what, fit):
    """Models fitted once per application and data folder: several queries
    score with the same ones."""
    key = (spark.sparkContext.applicationId, sf_dir, what)
    if key not in _fitted:
        _fitted[key] = fit()
    return _fitted[key]


def _cube_models(spark, sf_dir):
    """The legacy view (written once: guards, fits and the scoring read it) and
    both forests, each trained on its 70 % side."""
    cube = legacy(spark, sf_dir, materialized=True)

    def fit():
        out = {}
        for name, (feats, target, pred) in ML.MODELS.items():
            feats = ML.present_features(cube, feats)
            train = ML.train_frame(cube, feats, target).where(~ML.holdout_flag("District"))
            out[name] = (ML.fit(train, feats, target), feats, target, pred)
        return out
    return cube, _once(spark, sf_dir, "cube", fit)


# Forest outputs are no SQL, but what has to hold for them is: which rows are
# scored, on which side they fall, and that an average of training targets
# stays between the least and the largest of them.
def _whole(cols):
    return " AND ".join(f"{G.qi(c)} IS NOT NULL AND NOT isnan({G.qi(c)})" for c in cols)


def _per_model(sql):
    return WITH_LEGACY + "\n" + "\nUNION ALL\n".join(sql(n, f, t) for n, (f, t, _) in ML.MODELS.items())


@register("rf_predict", _per_model(lambda name, feats, target: f"""
SELECT '{name}' AS model, District, {_HOLD_SQL.format(k='District')} AS is_test, {G.qi(target)} AS label, true AS scored, true AS in_range
FROM legacy WHERE {_whole([*feats, target])}"""))
def q_rf_predict(spark, sf_dir):
    """Both forests, trained on the 70 % side of the cube, score every complete
    row: all are scored, and each prediction lies in the training targets' range."""
    cube, models = _cube_models(spark, sf_dir)
    parts = []
    for name, (model, feats, target, pred) in models.items():
        data = ML.train_frame(cube, feats, target, check=False).withColumn("is_test", ML.holdout_flag("District"))
        low, high = (data.where(~F.col("is_test")).agg(f(f"`{target}`")).scalar() for f in (F.min, F.max))
        p = F.col(pred)
        parts.append(ML.score(model, data, feats, pred, digits=None).select(
            F.lit(name).alias("model"), "District", "is_test", F.col(f"`{target}`").alias("label"), p.isNotNull().alias("scored"),
            ((p >= low - 1e-9) & (p <= high + 1e-9)).alias("in_range")))
    return reduce(lambda a, b: a.unionByName(b), parts)


@register("rf_holdout_metrics", _per_model(lambda name, feats, target: f"""
SELECT '{name}' AS model, CASE WHEN {_HOLD_SQL.format(k='District')} THEN 'test' ELSE 'train' END AS split,
       CAST(count(*) AS BIGINT) AS n, true AS r2_at_most_1, true AS mae_within_spread
FROM legacy WHERE {_whole([*feats, target])} GROUP BY 2"""))
def q_rf_holdout_metrics(spark, sf_dir):
    """R2 and MAE of the fitted forests on both sides, as bounds: R2 is at most
    1, and the error cannot exceed the spread of all targets."""
    cube, models = _cube_models(spark, sf_dir)
    parts = []
    for name, (model, feats, target, pred) in models.items():
        data = ML.train_frame(cube, feats, target, check=False) \
            .withColumn("split", F.when(ML.holdout_flag("District"), F.lit("test")).otherwise(F.lit("train")))
        spread = data.agg(F.max(f"`{target}`") - F.min(f"`{target}`")).scalar()
        m = ML.regression_metrics(ML.score(model, data, feats, pred, digits=None), target, pred, "split")
        parts.append(m.select(F.lit(name).alias("model"), "split", "n", F.coalesce(F.col("r2") <= 1, F.lit(True)).alias("r2_at_most_1"),
                              F.col("mae").between(F.lit(0.0), spread + 1e-9).alias("mae_within_spread")))
    return reduce(lambda a, b: a.unionByName(b), parts)


@register("feature_importance", "SELECT * FROM (VALUES " + ", ".join(
    f"('{n}', CAST({len(f)} AS BIGINT), 1.0::DOUBLE, true, true)" for n, (f, _, _) in ML.MODELS.items()) +
    ") t(model, features, total, ranked, named) WHERE EXISTS (SELECT 1 FROM lineitem)")
def q_feature_importance(spark, sf_dir):
    """Per model: every feature has an importance, they sum to 1, and the rank
    follows them."""
    cube, models = _cube_models(spark, sf_dir)
    parts = []
    for name, (m, feats, _, _) in models.items():
        t = ML.feature_importance(spark, m, feats, name)
        parts.append(t.agg(F.count(F.lit(1)).cast("long").alias("features"), X.rnd(F.sum("importance"), 6).alias("total"),
                           (F.sort_array(F.collect_list(F.struct("rank", "importance"))).getField("importance")
                            == F.sort_array(F.collect_list("importance"), asc=False)).alias("ranked"),
                           F.every(F.col("feature").isin(*cube.columns)).alias("named"))
                     .select(F.lit(name).alias("model"), "*"))
    return reduce(lambda a, b: a.unionByName(b), parts)


@register("batch_score", WITH_LEGACY + "\nSELECT District, " + ", ".join(
    f"({_whole(f)}) AS {G.qi(p)}" for f, _, p in ML.MODELS.values()) + " FROM legacy")
def q_batch_score(spark, sf_dir):
    """Both models score every cube row: no row is dropped, and exactly the
    rows with all features have a prediction."""
    cube, models = _cube_models(spark, sf_dir)
    out = cube
    for name, (m, feats, _, pred) in models.items():
        out = ML.score(m, out, feats, pred)
    return out.select("District", *[F.col(p).isNotNull().alias(p) for _, (_, _, _, p) in models.items()])


@register("predictions_stored", WITH_LEGACY + "\nSELECT District, " + ", ".join(
    f"({_whole(f)}) AS {G.qi(p)}" for f, _, p in ML.MODELS.values()) + ", true AS same_as_fresh, CAST(2 AS BIGINT) AS runs FROM legacy")
def q_predictions_stored(spark, sf_dir):
    """Models saved and loaded again score the cube, and two scoring runs are
    appended to the predictions table: read back, every district has both runs
    and the loaded models' predictions equal the fitted ones'."""
    cube, models = _cube_models(spark, sf_dir)
    base = scratch_path(spark, f"models-{uuid.uuid4().hex[:12]}")
    fresh, loaded = cube, cube
    for name, (m, feats, _, pred) in models.items():
        ML.save_model(m, f"{base}/{name}")
        fresh = ML.score(m, fresh, feats, pred)
        loaded = ML.score(ML.load_model(f"{base}/{name}"), loaded, feats, pred)
    preds = [p for _, (_, _, _, p) in models.items()]
    for df, ts in ((fresh, "2025-11-30 00:00:00"), (loaded, "2025-12-01 00:00:00")):
        ML.write_predictions(df.select("District", *preds), f"{base}/predictions", ts)
    both = spark.read.parquet(f"{base}/predictions").groupBy("District").agg(
        *[F.first(p).alias(p) for p in preds], F.countDistinct("run_ts").alias("runs"),
        *[F.count_distinct(p).alias(f"__{p}") for p in preds])
    same = reduce(lambda a, b: a & b, [F.col(f"__{p}") <= 1 for p in preds])
    return both.select("District", *[F.col(p).isNotNull().alias(p) for p in preds], same.alias("same_as_fresh"), F.col("runs").cast("long").alias("runs"))


# Requests built from events, with fields missing in patterns by type.
_REQ_COLS = {
    "PW_Anaemia_Rate": "CASE WHEN event_type IN ('click', 'view') THEN value END",
    "Optimum_WG_Latest_": "CASE WHEN event_type <> 'error' THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) END",
    "PW_Hb_Measured_": "CASE WHEN event_type = 'signup' THEN value * 2 END",
    "Measurement_Efficiency": "CASE WHEN event_type IN ('click', 'signup') THEN value END",
    "HV_Percentage": "CASE WHEN event_type = 'view' THEN 0.0 END",
    "SAM_Rate_": "CASE WHEN event_type = 'error' AND value > 10 THEN value / 10 END",
    "SUW_Rate_": "CAST(NULL AS DOUBLE)",
    "Active_AWC_": "CASE WHEN event_type = 'purchase' THEN value END",
    "LBW_Rate_": "CASE WHEN event_type = 'error' THEN value END",
}


def event_requests(spark, sf_dir):
    ev = A.table(spark, sf_dir, "events")
    cols = {k: F.expr(v.replace("json_extract_string", "get_json_object")).cast("double").alias(k)
            for k, v in _REQ_COLS.items()}
    return ev.select(F.col("event_id").alias("request_id"), *cols.values())


def _prep_sql():
    inv = {feat: fld for fld, feat in ML.REQUEST_FIELDS.items()}
    parts = []
    for name, (feats, _, _) in ML.MODELS.items():
        vals = [f"coalesce(CAST({_REQ_COLS[inv[f]]} AS DOUBLE), 0.0)" for f in feats]
        supplied = " OR ".join(f"({_REQ_COLS[inv[f]]}) IS NOT NULL" for f in feats)
        used = "array_to_string(list_filter([" + ", ".join(
            f"CASE WHEN {v} <> 0 THEN '{f}' END" for f, v in zip(feats, vals)) + "], lambda x: x IS NOT NULL), ',')"
        nused = " + ".join(f"CASE WHEN {v} <> 0 THEN 1 ELSE 0 END" for v in vals)
        missing = "array_to_string(list_filter([" + ", ".join(
            f"CASE WHEN ({_REQ_COLS[inv[f]]}) IS NULL THEN '{f}' END" for f in feats) + "], lambda x: x IS NOT NULL), ',')"
        parts.append(f"SELECT event_id AS request_id, '{name}' AS model, "
                     f"CASE WHEN {supplied} THEN 'ok' ELSE 'no_valid_features' END AS status, "
                     f"{used} AS features_used, CAST({nused} AS BIGINT) AS n_used, {missing} AS features_missing, "
                     f"{G.rnd(' + '.join(vals), 6)} AS feature_sum FROM events")
    return "\nUNION ALL\n".join(parts)


@register("score_requests", _prep_sql())
def q_score_requests(spark, sf_dir):
    req = event_requests(spark, sf_dir)
    parts = []
    for name, (feats, _, _) in ML.MODELS.items():
        p = ML.prepare_requests(req, feats)
        total = reduce(lambda a, b: a + b, [F.col(f"`{f}`") for f in feats])
        parts.append(p.select("request_id", F.lit(name).alias("model"), "status",
                              F.array_join("features_used", ",").alias("features_used"),
                              F.size("features_used").cast("long").alias("n_used"),
                              F.array_join("features_missing", ",").alias("features_missing"),
                              X.rnd(total, 6).alias("feature_sum")))
    return reduce(lambda a, b: a.unionByName(b), parts)


@register("score_requests_predict", f"SELECT request_id, model, status, status = 'ok' AS scored FROM ({_prep_sql()}) p")
def q_score_requests_predict(spark, sf_dir):
    """Requests scored by both cube models; exactly the requests with a valid
    field get a prediction, the others keep their status."""
    _, models = _cube_models(spark, sf_dir)
    req = event_requests(spark, sf_dir)
    parts = []
    for name, (m, feats, _, pred) in models.items():
        p = ML.prepare_requests(req, feats)
        s = ML.score(m, p, feats, "prediction_2dp")
        prediction = F.when(F.col("status") == "ok", F.col("prediction_2dp"))
        parts.append(s.select("request_id", F.lit(name).alias("model"), "status", prediction.isNotNull().alias("scored")))
    return reduce(lambda a, b: a.unionByName(b), parts)


# A target with a known rule: which size a part has decides it alone. A forest that
# learns finds it on rows it has not seen, one without anything to learn does not.
_PLANTED = "CASE WHEN p_size <= 25 THEN 10.0 ELSE 50.0 END"
PLANTED_FEATURES = ["size", "price", "noise"]


def planted_parts(spark, sf_dir):
    """Parts with their features (every fiftieth without a size), the planted
    target, a target dealt at random, and the exact split."""
    p = A.table(spark, sf_dir, "part")
    code = lambda salt, m: F.expr(f"crc32(cast(concat('{salt}', cast(p_partkey as string)) as binary)) % {m}")
    rows = p.select("p_partkey", F.when(F.col("p_partkey") % 50 != 0, F.col("p_size").cast("double")).alias("size"),
                    F.col("p_retailprice").cast("double").alias("price"), (code("n", 1000) / 1000).alias("noise"),
                    F.expr(_PLANTED).cast("double").alias("planted"), F.when(code("s", 2) == 0, 10.0).otherwise(50.0).alias("random"))
    return ML.exact_split(rows, "p_partkey")


def _planted_models(spark, sf_dir):
    rows = planted_parts(spark, sf_dir)

    def fit():
        data = ML.train_frame(rows.where("not is_test"), PLANTED_FEATURES, "planted")
        return {t: ML.fit(data, PLANTED_FEATURES, t, num_trees=20, max_depth=6) for t in ("planted", "random")}
    return rows, _once(spark, sf_dir, "planted", fit)


_PARTS_SQL = f"""(SELECT p_partkey, p_partkey % 50 <> 0 AS whole, {_PLANTED}::DOUBLE AS planted,
  row_number() OVER (ORDER BY md5(CAST(p_partkey AS VARCHAR))) <= ceil(0.3 * count(*) OVER ()) AS is_test FROM part) p"""


@register("rf_planted_metrics", f"""
SELECT model, CASE WHEN is_test THEN 'test' ELSE 'train' END AS split, CAST(count(*) AS BIGINT) AS n, model = 'planted' AS r2_above_09,
       model = 'planted' AS mae_below_1
FROM {_PARTS_SQL}, (VALUES ('planted'), ('random')) m(model) WHERE whole GROUP BY ALL""")
def q_rf_planted_metrics(spark, sf_dir):
    """R2 and MAE on both sides: the planted rule is learnt (R2 above 0.9, also on
    the rows held out), a target dealt at random is not. A constant fails."""
    rows, models = _planted_models(spark, sf_dir)
    side = F.when(F.col("is_test"), "test").otherwise("train")
    parts = []
    for target, model in models.items():
        scored = ML.score(model, rows.withColumn("split", side), PLANTED_FEATURES, "p", digits=None)
        parts.append(ML.regression_metrics(scored, target, "p", "split").select(
            F.lit(target).alias("model"), "split", "n", (F.col("r2") > 0.9).alias("r2_above_09"), (F.col("mae") < 1).alias("mae_below_1")))
    return reduce(lambda a, b: a.unionByName(b), parts)


@register("rf_planted_importance", """
SELECT f AS feature, CAST(row_number() OVER (ORDER BY f <> 'size', f) AS BIGINT) = 1 AS leads, f = 'size' AS above_09
FROM (VALUES ('size'), ('price'), ('noise')) t(f) WHERE EXISTS (SELECT 1 FROM part)""")
def q_rf_planted_importance(spark, sf_dir):
    """The feature of the planted rule has nearly all of the importance."""
    rows, models = _planted_models(spark, sf_dir)
    t = ML.feature_importance(spark, models["planted"], PLANTED_FEATURES, "planted")
    return t.select("feature", (F.col("rank") == 1).alias("leads"), (F.col("importance") > 0.9).alias("above_09"))


@register("rf_planted_score", f"SELECT p_partkey, whole AS scored, CASE WHEN whole THEN planted END AS prediction FROM {_PARTS_SQL}")
def q_rf_planted_score(spark, sf_dir):
    """Batch scoring with the planted model: every row is there, rows without a
    feature are not scored, all others get the rule's value."""
    rows, models = _planted_models(spark, sf_dir)
    scored = ML.score(models["planted"], rows, PLANTED_FEATURES, "prediction")
    return scored.select("p_partkey", F.col("prediction").isNotNull().alias("scored"), "prediction")


@register("rf_planted_requests", """
SELECT event_id AS request_id, CASE WHEN event_type = 'error' THEN 'no_valid_features' ELSE 'ok' END AS status,
       CASE WHEN event_type <> 'error' THEN CASE WHEN event_type = 'click' AND floor(value) > 25 THEN 50.0::DOUBLE ELSE 10.0::DOUBLE END END AS prediction
FROM events""")
def q_rf_planted_requests(spark, sf_dir):
    """Requests scored with the planted model: a missing size counts as 0, a
    request without any field keeps its status and gets no prediction."""
    _, models = _planted_models(spark, sf_dir)
    req = A.table(spark, sf_dir, "events").select(
        F.col("event_id").alias("request_id"), F.when(F.col("event_type") == "click", F.floor("value").cast("double")).alias("size_asked"),
        F.when(F.col("event_type") != "error", F.lit(950.0)).alias("price_asked"))
    p = ML.prepare_requests(req, PLANTED_FEATURES, mapping={"size_asked": "size", "price_asked": "price"})
    s = ML.score(models["planted"], p, PLANTED_FEATURES, "prediction_2dp")
    return s.select("request_id", "status", F.when(F.col("status") == "ok", F.col("prediction_2dp")).alias("prediction"))
