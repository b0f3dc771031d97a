"""Model selection, registry, forecast lookup and keyed-read queries."""
from __future__ import annotations

from pyspark.sql import functions as F

from airlens import constants as C
from airlens.modeling import models as MD
from airlens.modeling import moments as MO
from airlens.modeling import registry as RG
from airlens.modeling import selection as SE
from airlens.operators import evaluate as EV
from airlens.operators import features as FE
from airlens.operators import rollup as RU
from airlens.plans import q_eval as QE
from airlens.plans import sqlparts as Q
from airlens.plans.base import register, round_cols, round_doubles
from airlens.plans.q_profile import COMPLETE, FULL, features_complete, features_full
from airlens.session import materialise
from airlens.sources import feeds as SRC
from airlens.sources import standins as V


def _tail(ctes: str, **more) -> str:
    return ctes.rstrip("\n") + "".join(f",\n{k} AS ({v})" for k, v in more.items()) + "\n"


# W18 / W19 -------------------------------------------------------------------
_POS = ("SELECT city, date, aqi_mean, aqi_lag1d, aqi_roll_mean_3, aqi_roll_mean_7, aqi_last6h, aqi_day1, "
        "row_number() OVER (PARTITION BY city ORDER BY date) AS rn, count(*) OVER (PARTITION BY city) AS n FROM f")


@register("w18_time_split", _tail(COMPLETE, p=_POS)
          + "SELECT city, date, CAST(rn AS INTEGER) AS rn, n, rn <= floor(n * 0.8) AS is_train FROM p")
def w18_time_split(spark, sf_dir):
    return SE.time_split(features_complete(spark, sf_dir, ["city", "date"])).select("city", "date", "rn", "n", "is_train")


_FOLDS = " UNION ALL ".join(
    f"SELECT *, {k} AS fold, CASE WHEN rn <= n - {4 - k} * (n // 4) THEN 'train' "
    f"WHEN rn <= n - {3 - k} * (n // 4) THEN 'test' END AS role FROM p" for k in (1, 2, 3))


@register("w19_expanding_folds", _tail(COMPLETE, p=_POS, fo=_FOLDS)
          + "SELECT city, date, CAST(rn AS INTEGER) AS rn, fold, role FROM fo WHERE role IS NOT NULL")
def w19_expanding_folds(spark, sf_dir):
    return SE.expanding_folds(features_complete(spark, sf_dir, ["city", "date"])).select("city", "date", "rn", "fold", "role")


CANDIDATES = {"persistence": "aqi_mean", "lag1": "aqi_lag1d", "roll_mean_3": "aqi_roll_mean_3",
              "roll_mean_7": "aqi_roll_mean_7", "last6h": "aqi_last6h"}
ORDER = {k: i for i, k in enumerate(list(CANDIDATES) + ["ridge_1f"])}

_FIXED = " UNION ALL ".join(
    f"SELECT city, '{n}' AS candidate, fold, sqrt(avg((aqi_day1 - {c}) ** 2)) AS rmse FROM fo "
    f"WHERE role = 'test' AND aqi_day1 IS NOT NULL GROUP BY city, fold" for n, c in CANDIDATES.items())
_RIDGE = ("SELECT t.city, 'ridge_1f' AS candidate, t.fold, sqrt(avg((t.aqi_day1 - (my + coef * (t.aqi_mean - mx) / sx)) ** 2)) AS rmse "
          "FROM fo t JOIN (SELECT city, fold, avg(aqi_mean) AS mx, avg(aqi_day1) AS my, stddev_pop(aqi_mean) AS sx, "
          "count(*) * covar_pop(aqi_mean, aqi_day1) / (stddev_pop(aqi_mean) * (count(*) + 10.0)) AS coef "
          "FROM fo WHERE role = 'train' AND aqi_mean IS NOT NULL AND aqi_day1 IS NOT NULL GROUP BY city, fold) m "
          "ON t.city = m.city AND t.fold = m.fold WHERE t.role = 'test' AND t.aqi_mean IS NOT NULL AND t.aqi_day1 IS NOT NULL "
          "GROUP BY t.city, t.fold")
_ORD = "CASE candidate " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in ORDER.items()) + " END"


@register("m02_a21_cv_selection", _tail(COMPLETE, p=_POS, fo=_FOLDS, sc=f"{_FIXED} UNION ALL {_RIDGE}")
          + "SELECT city, candidate, round(cv_rmse, 6) AS cv_rmse, CAST(rank AS INTEGER) AS rank, rank = 1 AS is_winner FROM ("
            f"SELECT city, candidate, cv_rmse, row_number() OVER (PARTITION BY city ORDER BY round(cv_rmse, 9), {_ORD}, candidate) AS rank "
            "FROM (SELECT city, candidate, avg(rmse) AS cv_rmse FROM sc GROUP BY ALL))")
def m02_cv_selection(spark, sf_dir):
    """Expanding-window CV of five fixed forecasters and a one-feature
    ridge fitted per fold; winner = lowest mean fold RMSE per city."""
    folds = materialise(SE.expanding_folds(features_complete(
        spark, sf_dir, ["city", "date", "aqi_mean", "aqi_day1", *CANDIDATES.values()])), "folds")
    sc = SE.score_fixed_candidates(folds, "aqi_day1", CANDIDATES).unionByName(
        SE.score_ridge_one_feature(folds, "aqi_day1", "aqi_mean"))
    return round_cols(SE.select_winner(sc, order=ORDER), ["cv_rmse"])


_ALPHAS = (0.1, 10.0, 1000.0)
_POOLED = ("SELECT a.alpha, t.fold, sqrt(avg((t.aqi_day1 - (my + cxy / (vx + a.alpha / m.n) * (t.aqi_mean - mx) "
           "* CASE WHEN vx > 0 THEN 1 ELSE 0 END)) ** 2)) AS rmse FROM fo t JOIN (SELECT fold, avg(aqi_mean) AS mx, avg(aqi_day1) AS my, "
           "var_pop(aqi_mean) AS vx, covar_pop(aqi_mean, aqi_day1) AS cxy, count(*) AS n FROM fo WHERE role = 'train' GROUP BY fold) m "
           "ON t.fold = m.fold, (VALUES " + ", ".join(f"({a}::DOUBLE)" for a in _ALPHAS) + ") a(alpha) WHERE t.role = 'test' GROUP BY ALL")


@register("m02_ridge_cv_moments", _tail(COMPLETE, p=_POS, fo=_FOLDS,
          sc=_POOLED.replace("cxy / (vx + a.alpha / m.n)", "m.n * cxy / (vx * (m.n + a.alpha))"))
          + "SELECT alpha, fold, round(rmse, 6) AS rmse FROM sc")
def m02_ridge_cv_moments(spark, sf_dir):
    """Every fold and penalty of a ridge from one pass of block moments."""
    f = features_complete(spark, sf_dir, ["city", "date", "aqi_mean", "aqi_day1"])
    scores = MO.ridge_cv(f, ["aqi_mean"], "aqi_day1", {}, _ALPHAS)
    out = spark.createDataFrame([(a, k + 1, x) for a, folds in scores.items() for k, x in enumerate(folds)],
                                "alpha double, fold int, rmse double")
    return round_cols(out, ["rmse"])


_BLOCKS = "SELECT *, CAST(floor((rn - 1) * 4 / n) AS INTEGER) AS b FROM p"


@register("m09_out_of_fold_chain", _tail(COMPLETE, p=_POS, bl=_BLOCKS,
          fit="SELECT k.b, avg(aqi_mean) AS mx, avg(aqi_day1) AS my, count(*) * covar_pop(aqi_mean, aqi_day1) / (var_pop(aqi_mean) * (count(*) + 10.0)) AS coef "
              "FROM range(4) k(b), bl WHERE bl.b <> k.b GROUP BY k.b")
          + "SELECT city, date, round(my + coef * (aqi_mean - mx), 5) AS pred_day1 FROM bl JOIN fit ON bl.b = fit.b")
def m09_out_of_fold_chain(spark, sf_dir):
    """Day-1 predictions for the chain by ridges that did not see the row."""
    f = features_complete(spark, sf_dir, ["city", "date", "aqi_mean", "aqi_day1"])
    tr = MD.Trained("aqi_day1", None, "ridge", {"alpha": C.RIDGE_ALPHA}, ["aqi_mean"], {}, {})
    return round_cols(MD.out_of_fold(f, tr, "pred_day1").select("city", "date", "pred_day1"), ["pred_day1"], 5)


# Registry (V6) ---------------------------------------------------------------
def registry_rows(spark, sf_dir):
    """One model version per (target, data year), scored on that year's
    persistence pairs."""
    pairs = QE._pairs(spark, sf_dir)
    e = F.col("actual") - F.col("predicted")
    m = pairs.groupBy("horizon", F.year("date").alias("yr")).agg(
        F.sqrt(F.avg(e * e)).alias("cv_rmse"), F.avg(F.abs(e)).alias("test_mae"), F.count(F.lit(1)).alias("data_rows_used"))
    return m.select(F.concat(F.lit("aqi_day"), F.col("horizon").cast("string")).alias("target"),
                    F.lit("persistence").alias("model_name"),
                    F.make_timestamp_ntz(F.col("yr"), F.lit(12), F.lit(31), F.lit(0), F.lit(0), F.lit(0)).alias("trained_at"),
                    "cv_rmse", "test_mae", "data_rows_used")


_REG0 = ("SELECT 'aqi_day' || CAST(horizon AS VARCHAR) AS target, 'persistence' AS model_name, "
         "make_timestamp(year(date), 12, 31, 0, 0, 0) AS trained_at, sqrt(avg((actual - predicted) * (actual - predicted))) AS cv_rmse, "
         "avg(abs(actual - predicted)) AS test_mae, count(*) AS data_rows_used FROM pairs GROUP BY horizon, year(date)")
_REG = ("SELECT *, 'v' || CAST(version_num AS VARCHAR) AS version, 'models/' || target || '_v' || CAST(version_num AS VARCHAR) AS model_path, "
        "CASE target WHEN 'aqi_day1' THEN 'High' WHEN 'aqi_day2' THEN 'Moderate' WHEN 'aqi_day3' THEN 'Low' ELSE 'Unknown' END AS confidence, "
        "'active' AS status FROM (SELECT *, CAST(row_number() OVER (PARTITION BY target ORDER BY trained_at, model_name) AS INTEGER) AS version_num FROM reg0)")
REG_SQL = Q.ctes(**QE.BASE, reg0=_REG0, reg=_REG)
_RET = ("SELECT * REPLACE (CASE WHEN row_number() OVER (PARTITION BY target ORDER BY version_num DESC) <= 2 "
        "THEN 'active' ELSE 'inactive' END AS status) FROM reg")
REG_COLS = "target, model_name, trained_at, round(cv_rmse, 6) AS cv_rmse, round(test_mae, 6) AS test_mae, data_rows_used, version_num, version, model_path, confidence, status"


def registered(spark, sf_dir):
    return RG.assign_versions(None, registry_rows(spark, sf_dir))


@register("k08_f06_f15_register_versions", REG_SQL + f"SELECT {REG_COLS} FROM reg")
def k08_register_versions(spark, sf_dir):
    return round_cols(registered(spark, sf_dir), ["cv_rmse", "test_mae"])


@register("t05_retention", REG_SQL.rstrip("\n") + f",\nret AS ({_RET})\nSELECT {REG_COLS} FROM ret")
def t05_retention(spark, sf_dir):
    return round_cols(RG.apply_retention(registered(spark, sf_dir)), ["cv_rmse", "test_mae"])


@register("s17_latest_active_model", REG_SQL.rstrip("\n") + f",\nret AS ({_RET})\n"
          "SELECT target, model_name, trained_at, round(cv_rmse, 6) AS cv_rmse, round(test_mae, 6) AS test_mae, data_rows_used, "
          "version_num, version, confidence, status FROM (SELECT *, row_number() OVER (PARTITION BY target ORDER BY version_num DESC) AS r "
          "FROM ret WHERE status = 'active') WHERE r = 1")
def s17_latest_active_model(spark, sf_dir):
    return round_cols(SRC.latest_active_models(RG.apply_retention(registered(spark, sf_dir))), ["cv_rmse", "test_mae"])


@register("j07_metadata_lookup", REG_SQL.rstrip("\n")
          + ",\nt AS (SELECT DISTINCT 'aqi_day' || CAST(horizon AS VARCHAR) AS target FROM pl UNION SELECT 'aqi_day4')\n"
          "SELECT t.target, coalesce(m.model_name, 'unknown') AS model_name, coalesce(m.version, 'n/a') AS version, "
          "round(m.cv_rmse, 6) AS cv_rmse, CAST(NULL AS DOUBLE) AS test_r2, "
          "CASE t.target WHEN 'aqi_day1' THEN 'High' WHEN 'aqi_day2' THEN 'Moderate' WHEN 'aqi_day3' THEN 'Low' ELSE 'Unknown' END AS confidence "
          "FROM t LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY target ORDER BY version_num DESC) AS r "
          "FROM reg WHERE status = 'active') WHERE r = 1) m ON t.target = m.target")
def j07_metadata_lookup(spark, sf_dir):
    pl = QE._base(spark, sf_dir)[2]
    targets = (pl.select(F.concat(F.lit("aqi_day"), F.col("horizon").cast("string")).alias("target"))
                 .unionByName(spark.range(1).select(F.lit("aqi_day4").alias("target"))))
    meta = registered(spark, sf_dir).withColumn("test_r2", F.lit(None).cast("double"))
    return round_cols(RG.lookup(targets, meta), ["cv_rmse"])


# J08 / S15 -------------------------------------------------------------------
_LAT = ("SELECT city, date, aqi_mean FROM (SELECT *, row_number() OVER (PARTITION BY city ORDER BY date DESC) AS r FROM ("
        "SELECT city, CAST(\"timestamp\" AS DATE) AS date, avg(aqi) AS aqi_mean FROM v3 GROUP BY ALL UNION ALL "
        "SELECT city, CAST(\"timestamp\" AS DATE), avg(aqi) FROM v1 GROUP BY ALL)) WHERE r = 1")


@register("j08_s15_current_or_daily", Q.ctes(v1=Q.V1, v3=Q.V3, lat=_LAT)
          + "SELECT l.city, l.date AS latest_date, coalesce(c.at, CAST(l.date AS TIMESTAMP)) AS current_at, coalesce(c.aqi, l.aqi_mean, 0.0) AS current_aqi, "
            "CASE WHEN c.aqi IS NOT NULL THEN 'current' WHEN l.aqi_mean IS NOT NULL THEN 'daily' ELSE 'none' END AS source "
            "FROM lat l LEFT JOIN (SELECT city, arg_max(aqi, (\"timestamp\", aqi)) AS aqi, max(\"timestamp\") AS at FROM v1 WHERE aqi IS NOT NULL GROUP BY city) c "
            "ON l.city = c.city")
def j08_current_or_daily(spark, sf_dir):
    v1 = V.event_readings(spark, sf_dir)
    daily = V.daily_actuals(spark, sf_dir).unionByName(
        v1.groupBy("city", F.to_date("timestamp").alias("date")).agg(F.avg("aqi").alias("aqi_mean")))
    latest = SRC.latest_row(daily, "city", "date")
    return SRC.current_or_daily(latest, SRC.latest_reading(v1))


# J05 / J04 -------------------------------------------------------------------
_FCD = ("SELECT city, CAST(\"timestamp\" AS DATE) AS date, avg(temperature) AS temp_mean, avg(humidity) AS humidity_mean, "
        "avg(wind_speed) AS wind_mean, avg(pressure) AS pressure_mean, coalesce(sum(precipitation), 0.0) AS precip_sum FROM v2 GROUP BY ALL")
_FC = ("SELECT city, " + ", ".join(f"max(CASE WHEN h = {h} THEN {s} END) AS fc_{n}_d{h}" for n, s in Q.LEADS for h in (1, 2, 3))
       + " FROM (SELECT f.*, datediff('day', a.as_of, f.date) AS h FROM fcd f JOIN "
         "(SELECT city, max(date) - 4 AS as_of FROM fcd GROUP BY city) a ON f.city = a.city) WHERE h BETWEEN 1 AND 3 GROUP BY city")
FC_COLS = [f"fc_{n}_d{h}" for n, _ in Q.LEADS for h in (1, 2, 3)]


def forecast_table(spark, sf_dir):
    fcd = RU.forecast_daily(V.hourly_readings(spark, sf_dir))
    as_of = fcd.groupBy("city").agg(F.date_sub(F.max("date"), 4).alias("as_of"))
    return FE.forecast_features(fcd, as_of)


@register("j05_forecast_lookup", Q.ctes(v1=Q.V1, v2=Q.V2, fcd=_FCD, fc=_FC)
          + "SELECT city, " + ", ".join(f"round({c}, 6) AS {c}" for c in FC_COLS) + " FROM fc")
def j05_forecast_lookup(spark, sf_dir):
    return round_cols(forecast_table(spark, sf_dir), FC_COLS)


_F0 = ("SELECT *, " + ", ".join(f"{e} AS {n}" for n, e in Q.feature_exprs(targets=False))
       + ", row_number() OVER (PARTITION BY city ORDER BY date DESC) = 1 AS is_last FROM d")
_F1 = ("SELECT f0.* EXCLUDE (is_last) REPLACE (" + ", ".join(
    f"CASE WHEN is_last THEN coalesce(fc.{c}, f0.{c}) ELSE f0.{c} END AS {c}" for c in FC_COLS)
       + ") FROM f0 LEFT JOIN fc ON f0.city = fc.city")
_J04_COLS = ["city", "date"] + Q.DAILY_NAMES + [n for n, _ in Q.feature_exprs(targets=False)] + ["fc_pressure_drop_d1"]


@register("j04_w10_last_row_override", Q.ctes(v1=Q.V1, v2=Q.V2, fcd=_FCD, fc=_FC, d=Q.daily("v2"), f0=_F0, f1=_F1,
                                              f2="SELECT *, pressure_mean - fc_pressure_d1 AS fc_pressure_drop_d1 FROM f1")
          + f"SELECT {Q.select_rounded(_J04_COLS, set(_J04_COLS) - {'city', 'date', 'dow'})} FROM f2 WHERE {Q.not_null(C.FEATURE_COLS)}")
def j04_last_row_override(spark, sf_dir):
    """Live feature rows (no targets): the last row of each city takes the
    looked-up forecast instead of the (missing) lead values."""
    f = FE.compute_features(V.hourly_readings(spark, sf_dir), compute_targets=False,
                            forecast=forecast_table(spark, sf_dir))
    return round_doubles(f)


# S10-S14 ---------------------------------------------------------------------
@register("s10_training_rows", FULL + f"SELECT city, date, aqi_mean, {', '.join(C.TARGETS)} FROM f WHERE {Q.not_null(C.TARGETS)}")
def s10_training_rows(spark, sf_dir):
    return SRC.training_rows(features_full(spark, sf_dir, ["city", "date", "aqi_mean", *C.TARGETS])).select("city", "date", "aqi_mean", *C.TARGETS)


@register("s11_latest_feature_row", FULL + "SELECT city, date, aqi_mean, round(aqi_roll_mean_7, 6) AS aqi_roll_mean_7, aqi_lag1d FROM "
          "(SELECT *, row_number() OVER (PARTITION BY city ORDER BY date DESC) AS r FROM f) WHERE r = 1")
def s11_latest_feature_row(spark, sf_dir):
    f = features_full(spark, sf_dir, ["city", "date", "aqi_mean", "aqi_roll_mean_7", "aqi_lag1d"])
    return round_cols(SRC.latest_row(f, "city", "date"), ["aqi_roll_mean_7"])


@register("t01_time_order", Q.ctes(v3=Q.V3, act=QE.ACT) + "SELECT city, date, aqi_mean, CAST(row_number() OVER (PARTITION BY city ORDER BY date) AS INTEGER) AS rn "
          "FROM act ORDER BY city, date")
def t01_time_order(spark, sf_dir):
    """Rows in the order of time, with their position in it."""
    return SE.positions(V.daily_actuals(spark, sf_dir)).drop("n").orderBy("city", "date")


@register("s12_feature_history", Q.ctes(v3=Q.V3, act=QE.ACT)
          + "SELECT * FROM act WHERE date >= TIMESTAMP '2001-06-30 00:00:00' - INTERVAL 30 DAY")
def s12_feature_history(spark, sf_dir):
    return SRC.recent(V.daily_actuals(spark, sf_dir), "2001-06-30 00:00:00", 30, ts="date")


@register("s13_past_predictions", Q.ctes(v3=Q.V3, act=QE.ACT, preds=QE.PREDS)
          + "SELECT city, prediction_date, p1 AS day1_aqi FROM preds WHERE prediction_date >= TIMESTAMP '2001-06-30 00:00:00' - INTERVAL 14 DAY")
def s13_past_predictions(spark, sf_dir):
    # The window and a month before it: a prediction looks back three rows.
    since = F.date_sub(F.lit("2001-06-30").cast("date"), 14 + 30)
    p = QE._base(spark, sf_dir, since)[1]
    return SRC.recent(p, "2001-06-30 00:00:00", 14, ts="prediction_date").select(
        "city", "prediction_date", F.col("day1.aqi").alias("day1_aqi"))


@register("s14_actuals_projection", COMPLETE + "SELECT city, date, aqi_mean FROM f WHERE aqi_mean IS NOT NULL")
def s14_actuals_projection(spark, sf_dir):
    return SRC.actuals(features_complete(spark, sf_dir, ["city", "date", "aqi_mean"]))
