"""pyspark.ml queries (M01-M11, M13-M15, C05, C06) on the daily feature table.

Model fitting has no SQL twin except the one-feature ridge, whose closed
form is exact; the others are checked on row counts plus the properties
in tests (attributions sum to the prediction, chain guard, folds).
"""
from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import functions as F

from airlens import constants as C
from airlens.modeling import models as MD
from airlens.modeling import registry as RG
from airlens.plans import flows as FL
from airlens.plans.base import register, round_cols
from airlens.plans.q_profile import COMPLETE, FULL, features_complete, features_full
from airlens.session import materialise
from airlens.sinks import store as ST
from airlens.sources import feeds as SRC

# Sizes of the registered runs: one point per kind of model, or all 17 points
# of constants.MODEL_GRIDS with a twentieth of their trees.  The flows default
# to the full grids.
SMALL_GRID = {"ridge": [{"alpha": C.RIDGE_ALPHA}],
              "gradient_boosting": [{"maxIter": 5, "stepSize": 0.1, "maxDepth": 3}],
              "random_forest": [{"numTrees": 10, "maxDepth": 4, "minInstancesPerNode": 8,
                                 "featureSubsetStrategy": "0.7"}]}
EVERY_POINT = MD.scaled(C.MODEL_GRIDS, 0.05)
RIDGE = {"ridge": C.MODEL_GRIDS["ridge"]}
TRAINED_AT = dt.datetime(2024, 1, 1)


@register("m07_ridge_one_feature", COMPLETE
          + "SELECT round(coef, 6) AS coef, round(my - coef * mx, 6) AS intercept, n FROM ("
            "SELECT count(*) * covar_pop(aqi_mean, aqi_day1) / (var_pop(aqi_mean) * (count(*) + 10.0)) AS coef, "
            "avg(aqi_mean) AS mx, avg(aqi_day1) AS my, count(*) AS n FROM f)")
def m07_ridge_one_feature(spark, sf_dir):
    """Standardised ridge (alpha 10) with Spark ML on one feature; equals
    the closed form n*cov/(var*(n+alpha))."""
    f = features_complete(spark, sf_dir, ["aqi_mean", "aqi_day1"])
    m = MD.fit(f, ["aqi_mean"], "aqi_day1", "ridge", {"alpha": C.RIDGE_ALPHA})
    lm = m.stages[-1]
    n = f.count()
    out = spark.createDataFrame([(float(lm.coefficients[0]), float(lm.intercept), n)],
                                "coef double, intercept double, n long")
    return round_cols(out, ["coef", "intercept"])


@register("m08_m09_c05_model_competition")
def m08_model_competition(spark, sf_dir):
    """Three horizons, each a CV competition over all features; day 2 uses
    pred_day1, day 3 uses pred_day1 and pred_day2."""
    chain, _ = MD.train_chain(features_complete(spark, sf_dir), grids=SMALL_GRID)
    return MD.candidates_frame(spark, chain)


_POINTS = ", ".join(f"({k}, '{family}', '{json.dumps(p)}')" for k, (family, p) in enumerate(
    (family, p) for family, points in EVERY_POINT.items() for p in points))
_COUNTS = (",\np AS (SELECT city, floor(count(*) * 0.8) AS k, count(*) AS n FROM f GROUP BY city),\n"
           "c AS (SELECT CAST(sum(k) AS BIGINT) AS train_rows, CAST(sum(n - k) AS BIGINT) AS test_rows, "
           + ", ".join(f"CAST(sum(k - {4 - i} * floor(k / 4)) AS BIGINT) AS fold{i}_train, CAST(sum(floor(k / 4)) AS BIGINT) AS fold{i}_test" for i in (1, 2, 3))
           + " FROM p)\n")


@register("c05_training_run", COMPLETE.rstrip("\n") + _COUNTS
          + "SELECT t.target, CAST(v.point AS INTEGER) AS point, v.model, v.params, CAST(52 + t.extra AS INTEGER) AS feature_count, "
            "c.*, true AS scored, true AS winner_is_lowest, true AS winner_is_stored, 1 AS version_num "
            f"FROM (VALUES ('aqi_day1', 0), ('aqi_day2', 1), ('aqi_day3', 2)) t(target, extra), (VALUES {_POINTS}) v(point, model, params), c")
def c05_training_run(spark, sf_dir):
    """All 17 grid points over all features for three horizons; pipelines and
    registry are written, and the registry is read back.  Exact are the
    candidates, row counts, folds and that the lowest CV error won."""
    base = ST.scratch_path(spark, "training")
    chain = FL.training_run(spark, features_complete(spark, sf_dir), f"{base}/registry", f"{base}/models", TRAINED_AT,
                            grids=EVERY_POINT)
    stored = ST.read_table(spark, f"{base}/registry").select(
        "target", "version_num", "feature_count", F.col("model_name").alias("stored"), F.col("params").alias("stored_params"),
        F.size("features").alias("n_stored"))
    sizes = spark.createDataFrame(
        [(t.target, t.rows["train"], t.rows["test"], *(t.rows["folds"][i, r] for i in (1, 2, 3) for r in ("train", "test")))
         for t in chain], "target string, train_rows long, test_rows long, " + ", ".join(
             f"fold{i}_{r} long" for i in (1, 2, 3) for r in ("train", "test")))
    cands = MD.candidates_frame(spark, chain)
    best = cands.groupBy("target").agg(F.min("cv_rmse").alias("lowest"),
                                       F.max(F.when(F.col("is_winner"), F.struct("cv_rmse", "model", "params"))).alias("w"))
    return (cands.join(best, "target").join(stored, "target").join(sizes, "target")
            .select("target", "point", "model", "params", "feature_count", *[c for c in sizes.columns if c != "target"],
                    (F.col("cv_rmse").isNotNull() & F.col("test_rmse").isNotNull() & F.col("test_mae").isNotNull()
                     & F.col("test_r2").isNotNull()).alias("scored"), (F.col("w.cv_rmse") == F.col("lowest")).alias("winner_is_lowest"),
                    ((F.col("stored") == F.col("w.model")) & (F.col("stored_params") == F.col("w.params"))
                     & (F.col("n_stored") == F.col("feature_count"))).alias("winner_is_stored"), "version_num"))


def _trained(spark, sf_dir):
    """Features, the folder of a ridge training run, and its pipelines."""
    f, base = features_complete(spark, sf_dir), ST.scratch_path(spark, "training")
    chain = FL.training_run(spark, f, f"{base}/registry", f"{base}/models", TRAINED_AT, grids=RIDGE)
    return f, base, {t.target: t.model for t in chain}


@register("c06_prediction_run", COMPLETE
          + "SELECT city, max(date) + 1 AS prediction_date, true AS same_as_trained, 52 AS n_features, true AS adds_up FROM f GROUP BY city")
def c06_prediction_run(spark, sf_dir):
    """Train, register, then predict twice from the stored pipelines alone;
    the stored documents are read back and compared by a join with the scores
    of the pipelines in memory, and attributions add up to the prediction."""
    f, base, chain = _trained(spark, sf_dir)
    for _ in range(2):
        docs, phi = FL.prediction_run(spark, f, f"{base}/registry", f"{base}/predictions", "2024-01-02 00:00:00")
    latest = SRC.latest_row(f, "city", "date")
    own = MD.score_chain(latest, chain).select("city", "date", *[F.col(f"day{h}").alias(f"own{h}") for h in (1, 2, 3)])
    sums = (phi.groupBy("city").agg(F.sum("shap_value").alias("s"), F.max("base_value").alias("b"), F.count(F.lit(1)).alias("n"))
            .join(MD.predict(chain["aqi_day1"], latest).select("city", "prediction"), "city"))
    same = (F.col("day1") == F.col("own1")) & (F.col("day2") == F.col("own2")) & (F.col("day3") == F.col("own3"))
    return (docs.join(own, (docs["city"] == own["city"]) & (docs["prediction_date"] == F.date_add(own["date"], 1))).drop(own["city"])
            .join(sums, "city").select("city", "prediction_date", same.alias("same_as_trained"), F.col("n").cast("int").alias("n_features"),
                                       (F.abs(F.col("s") + F.col("b") - F.col("prediction")) < 1e-6).alias("adds_up")))


@register("m10_c06_score_latest")
def m10_score_latest(spark, sf_dir):
    """Scores of each city's latest row from the stored pipelines."""
    f, base, _ = _trained(spark, sf_dir)
    s = MD.score_chain(SRC.latest_row(f, "city", "date"), RG.load_latest(spark, f"{base}/registry"))
    return s.select("city", "date", *[F.col(f"day{h}.{x}").alias(f"day{h}_{x}") for h in (1, 2, 3) for x in ("aqi", "label")])


@register("m11_k08_save_load_register")
def m11_save_load_register(spark, sf_dir):
    """Three trainings are registered one after the other: versions count on,
    the oldest is retired and its pipeline deleted, and the newest is loaded."""
    f, base, chain = _trained(spark, sf_dir)
    meta = materialise(ST.read_table(spark, f"{base}/registry").drop("version_num", "version", "model_path", "confidence", "status"), "meta")
    for day in (1, 2):
        later = meta.withColumn("trained_at", F.col("trained_at") + F.make_dt_interval(F.lit(day)))
        RG.register(spark, f"{base}/registry", f"{base}/models", materialise(later, "meta"), chain)
    if len(RG.load_latest(spark, f"{base}/registry")) != 3:
        raise AssertionError("a latest active pipeline is missing")
    return ST.read_table(spark, f"{base}/registry").drop("features")


@register("m11_versions_exact", "SELECT 'aqi_day' || h AS target, CAST(v AS INTEGER) AS version_num, "
          "CASE WHEN v = 1 THEN 'inactive' ELSE 'active' END AS status, 'aqi_day' || h || '_v' || v AS folder, "
          "CASE h WHEN 1 THEN 'High' WHEN 2 THEN 'Moderate' ELSE 'Low' END AS confidence, v <> 1 AS stored "
          "FROM range(1, 4) a(h), range(1, 4) b(v)")
def m11_versions_exact(spark, sf_dir):
    """What is exact of three registrations: versions, status, folders, and
    which pipelines are still stored."""
    rows = m11_save_load_register(spark, sf_dir).select("target", "version_num", "status", "model_path", "confidence").collect()
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    out = [(r["target"], r["version_num"], r["status"], r["model_path"].rstrip("/").rsplit("/", 1)[-1], r["confidence"],
            path(r["model_path"]).getFileSystem(conf).exists(path(r["model_path"]))) for r in rows]
    return spark.createDataFrame(out, "target string, version_num int, status string, folder string, confidence string, stored boolean")


def _attributions(spark, sf_dir):
    """The latest rows, and (model, attributions, method) of a ridge and of boosted trees."""
    f = features_complete(spark, sf_dir)
    latest = materialise(SRC.latest_row(f, "city", "date"), "latest")
    ground = materialise(MD.recent_background(f, latest.agg(F.max("date")).first()[0]), "background")
    feats = MD.feature_columns(f, "aqi_day1")[0]
    out = []
    for family in ("ridge", "gradient_boosting"):
        model = MD.fit(f, feats, "aqi_day1", family, SMALL_GRID[family][0])
        out.append((model, *MD.explain(model, latest, ground, feats)))
    return latest, out


@register("m13_m14_m15_attribution")
def m13_attribution(spark, sf_dir):
    """Attributions of a ridge (exact) and of a boosted-tree model (sampled
    permutations) for the latest row of each city, against the last 30 days."""
    _, found = _attributions(spark, sf_dir)
    parts = [phi.select("city", "date", "feature", "shap_value", "base_value", F.lit(kind).alias("method")) for _, phi, kind in found]
    return parts[0].unionByName(parts[1])


@register("m13_attribution_sums", COMPLETE
          + "SELECT city, max(date) AS date, method, 52 AS n_features, true AS adds_up, true AS one_base "
            "FROM f, (VALUES ('linear'), ('permutation')) m(method) GROUP BY city, method")
def m13_attribution_sums(spark, sf_dir):
    """What is exact of attributions: every feature has one, and with the base
    value they add up to the model's own prediction."""
    latest, found = _attributions(spark, sf_dir)
    out = []
    for model, phi, kind in found:
        sums = phi.groupBy("city", "date").agg(F.sum("shap_value").alias("s"), F.min("base_value").alias("b"), F.max("base_value").alias("b2"),
                                               F.countDistinct("feature").alias("n"))
        own = MD.predict(model, latest).select("city", "prediction")
        out.append(sums.join(own, "city").select("city", "date", F.lit(kind).alias("method"), F.col("n").cast("int").alias("n_features"),
                                                 (F.abs(F.col("s") + F.col("b") - F.col("prediction")) < 1e-6).alias("adds_up"),
                                                 (F.col("b") == F.col("b2")).alias("one_base")))
    return out[0].unionByName(out[1])


IMPUTE_COLS = ["aqi_lag7d", "aqi_roll_mean_7", "aqi_pct_change", "fc_temp_d3", "aqi_day1"]


@register("m01_a06_f16_impute", FULL.rstrip("\n")
          + ",\np AS (SELECT *, row_number() OVER (PARTITION BY city ORDER BY date) AS rn, count(*) OVER (PARTITION BY city) AS n FROM f),\n"
          + "m AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}" for c in IMPUTE_COLS) + " FROM p WHERE rn <= floor(n * 0.8))\n"
          + "SELECT city, date, " + ", ".join(f"round(coalesce({c}, m_{c}, 0.0), 6) AS {c}" for c in IMPUTE_COLS)
          + " FROM f, m")
def m01_impute(spark, sf_dir):
    """Means fitted on the training rows only (first 80 % of each city),
    then null -> mean -> 0 on every row."""
    from airlens.modeling.selection import time_split
    f = features_full(spark, sf_dir, ["city", "date", *IMPUTE_COLS])
    means = MD.fit_means(time_split(f).where("is_train"), IMPUTE_COLS)
    return round_cols(MD.impute(f.select("city", "date", *IMPUTE_COLS), IMPUTE_COLS, means), IMPUTE_COLS)
