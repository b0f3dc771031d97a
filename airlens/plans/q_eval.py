"""Evaluation queries (V4: persistence predictions vs daily actuals)."""
from __future__ import annotations

from pyspark.sql import functions as F

from airlens import constants as C
from airlens.functions import scalars as S
from airlens.operators import evaluate as EV
from airlens.plans import sqlparts as Q
from airlens.plans.base import register, round_cols
from airlens.session import cut_lineage
from airlens.sinks import store as ST
from airlens.sources import standins as V

ACT = 'SELECT city, CAST("timestamp" AS DATE) AS date, avg(aqi) AS aqi_mean FROM v3 GROUP BY ALL'


def band_case(v: str, values, otherwise, parity: bool = False) -> str:
    """CASE over the bands of the constants table: contiguous bands by upper
    edge, or (parity) the integer edges themselves."""
    tests = [f"{v} BETWEEN {b[0]} AND {b[1]}" if parity else f"{v} <= {b[1]}" for b in C.AQI_BANDS]
    text = lambda x: f"'{x}'" if isinstance(x, str) else str(x)
    return "CASE " + " ".join(f"WHEN {t} THEN {text(x)}" for t, x in zip(tests, values)) + f" ELSE {text(otherwise)} END"


def label_sql(v: str) -> str:
    labels = [b[2] for b in C.AQI_BANDS]
    return f"CASE WHEN {v} IS NOT NULL THEN {band_case(f'greatest(0.0, {v})', labels, labels[-1])} END"


_W = "OVER (PARTITION BY city ORDER BY date)"
PREDS = ("SELECT city, date AS prediction_date, CAST(date AS TIMESTAMP) + INTERVAL 6 HOURS AS predicted_at, "
         + ", ".join(f"lag(aqi_mean, {h}) {_W} AS p{h}" for h in (1, 2, 3))
         + f", lag(date, 1) {_W} AS latest_date, lag(aqi_mean, 1) {_W} AS latest_aqi FROM act")
PL = " UNION ALL ".join(f"SELECT city, prediction_date, {h} AS horizon, p{h} AS predicted, {label_sql(f'p{h}')} AS label FROM preds"
                        for h in (1, 2, 3))
PAIRS = ("SELECT a.city, a.date, p.horizon, a.aqi_mean AS actual, p.predicted FROM act a JOIN pl p "
         "ON a.city = p.city AND a.date = p.prediction_date + (p.horizon - 1) "
         "WHERE a.aqi_mean IS NOT NULL AND p.predicted IS NOT NULL")
BASE = {"v3": Q.V3, "act": ACT, "preds": PREDS, "pl": PL, "pairs": PAIRS}
D1 = ("SELECT a.city, a.date, a.aqi_mean, p.p1 AS pred_aqi FROM act a JOIN preds p "
      "ON a.city = p.city AND a.date = p.prediction_date WHERE p.p1 IS NOT NULL")


def _base(spark, sf_dir, since=None):
    # Daily actuals are read by the prediction builder and by the join:
    # materialise the daily grain once (as a feature store would hold it).
    act = V.daily_actuals(spark, sf_dir)
    act = cut_lineage(act if since is None else act.where(F.col("date") >= since))
    preds = EV.persistence_predictions(act)
    return act, preds, EV.predictions_long(preds)


def _pairs(spark, sf_dir):
    act, _, pl = _base(spark, sf_dir)
    return EV.horizon_join(act, pl)


@register("p18_predictions_long", Q.ctes(**{k: v for k, v in BASE.items() if k != "pairs"})
          + "SELECT * FROM pl")
def p18_predictions_long(spark, sf_dir):
    return _base(spark, sf_dir)[2]


@register("k06_prediction_documents", Q.ctes(v3=Q.V3, act=ACT, preds=PREDS)
          + "SELECT city, prediction_date, predicted_at, p1 AS day1_aqi, " + label_sql("p1") + " AS day1_label, "
          + "p2 AS day2_aqi, " + label_sql("p2") + " AS day2_label, p3 AS day3_aqi, " + label_sql("p3")
          + " AS day3_label FROM preds")
def k06_prediction_documents(spark, sf_dir):
    """Nested prediction documents (struct per horizon), saved twice, read
    back and flattened for display."""
    path = ST.scratch_path(spark, "predictions")
    docs = _base(spark, sf_dir)[1]
    for _ in range(2):
        ST.save_predictions(docs, path)
    return ST.read_table(spark, path).select("city", "prediction_date", "predicted_at",
                    *[F.col(f"day{h}.{f}").alias(f"day{h}_{f}") for h in (1, 2, 3) for f in ("aqi", "label")])


@register("j03_horizon_join", Q.ctes(**BASE) + "SELECT * FROM pairs")
def j03_horizon_join(spark, sf_dir):
    return _pairs(spark, sf_dir)


_MET = ("SELECT city, horizon, CASE WHEN n >= 2 THEN round(sqrt(avg_e2), 6) END AS rmse, "
        "CASE WHEN n >= 2 THEN round(mae, 6) END AS mae, "
        "CASE WHEN n >= 2 THEN round(CASE WHEN sst > 0 THEN 1.0 - ssr / sst ELSE 0.0 END, 6) END AS r2, "
        "CASE WHEN n >= 2 THEN n ELSE 0 END AS n FROM (SELECT city, horizon, avg((actual - predicted) * (actual - predicted)) AS avg_e2, "
        "avg(abs(actual - predicted)) AS mae, sum((actual - predicted) * (actual - predicted)) AS ssr, "
        "var_pop(actual) * count(*) AS sst, count(*) AS n FROM pairs GROUP BY city, horizon)")


@register("a09_live_metrics", Q.ctes(**BASE) + _MET)
def a09_live_metrics(spark, sf_dir):
    return round_cols(EV.live_metrics(_pairs(spark, sf_dir), digits=None), ["rmse", "mae", "r2"])


@register("a08_regression_metrics", Q.ctes(**BASE)
          + "SELECT horizon, round(sqrt(avg((actual - predicted) * (actual - predicted))), 6) AS rmse, "
            "round(avg(abs(actual - predicted)), 6) AS mae, "
            "round(1.0 - sum((actual - predicted) * (actual - predicted)) / (var_pop(actual) * count(*)), 6) AS r2, "
            "count(*) AS n FROM pairs GROUP BY horizon")
def a08_regression_metrics(spark, sf_dir):
    return round_cols(EV.regression_metrics(_pairs(spark, sf_dir), digits=None), ["rmse", "mae", "r2"])


_RR = ("SELECT city, horizon, date, round(CASE WHEN count(e2) OVER w >= 3 THEN sqrt(avg(e2) OVER w) END, 6) AS rolling_rmse "
       "FROM (SELECT *, (actual - predicted) ** 2 AS e2, count(*) OVER (PARTITION BY city, horizon) AS n FROM pairs) "
       "WHERE n >= 7 WINDOW w AS (PARTITION BY city, horizon ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)")


@register("w15_rolling_rmse", Q.ctes(**BASE) + _RR)
def w15_rolling_rmse(spark, sf_dir):
    return round_cols(EV.rolling_rmse(_pairs(spark, sf_dir)), ["rolling_rmse"])


@register("f11_residuals", Q.ctes(**BASE)
          + "SELECT city, horizon, date, actual - predicted AS residual, actual - predicted > 0 AS under_predicted FROM pairs")
def f11_residuals(spark, sf_dir):
    return EV.residuals(_pairs(spark, sf_dir))


def _err_sql(latest: bool) -> str:
    err = "round_even((pred_aqi - aqi_mean) * 10.0, 0) / 10.0"
    base = "CASE WHEN aqi_mean = 0 THEN 1.0 ELSE aqi_mean END"
    acc = f"round_even(least(1.0, greatest(0.0, 1.0 - round_even(abs({err}) * 10.0, 0) / 10.0 / {base})) * 100 * 10.0, 0) / 10.0"
    tier = f"CASE WHEN abs({err}) > 30 THEN 'severe' WHEN abs({err}) > 15 THEN 'warn' WHEN {err} IS NOT NULL THEN 'ok' END"
    body = (f"SELECT city, date, aqi_mean AS actual, pred_aqi AS predicted, {err} AS error, "
            f"round_even(abs({err}) * 10.0, 0) / 10.0 AS abs_error, {acc} AS accuracy, {tier} AS tier, "
            f"strftime(date, '%d %b %Y') AS date_label, row_number() OVER (PARTITION BY city ORDER BY date DESC) AS rn FROM d1")
    return f"SELECT * EXCLUDE (rn) FROM ({body})" + (" WHERE rn <= 14" if latest else "")


@register("f08_f09_t03_error_table", Q.ctes(v3=Q.V3, act=ACT, preds=PREDS, d1=D1) + _err_sql(True))
def f08_f09_t03_error_table(spark, sf_dir):
    act, preds, _ = _base(spark, sf_dir)
    return EV.error_table(EV.day1_pairs(act, preds))


@register("j02_f08_error_log", Q.ctes(v3=Q.V3, act=ACT, preds=PREDS, d1=D1) + _err_sql(False))
def j02_f08_error_log(spark, sf_dir):
    act, preds, _ = _base(spark, sf_dir)
    return EV.error_table(EV.day1_pairs(act, preds), latest=None)


@register("p16_large_errors", Q.ctes(v3=Q.V3, act=ACT, preds=PREDS, d1=D1)
          + "SELECT * FROM d1 WHERE abs(aqi_mean - pred_aqi) > 20")
def p16_large_errors(spark, sf_dir):
    act, preds, _ = _base(spark, sf_dir)
    return EV.large_errors(EV.day1_pairs(act, preds))


@register("a12_accuracy_summary", Q.ctes(v3=Q.V3, act=ACT, preds=PREDS, d1=D1, t=_err_sql(True))
          + "SELECT city, round(avg(accuracy), 6) AS mean_accuracy, round(avg(abs_error), 6) AS mean_abs_error FROM t GROUP BY city")
def a12_accuracy_summary(spark, sf_dir):
    act, preds, _ = _base(spark, sf_dir)
    return round_cols(EV.accuracy_summary(EV.error_table(EV.day1_pairs(act, preds))), ["mean_accuracy", "mean_abs_error"])


@register("a10_prediction_spread", Q.ctes(**{k: v for k, v in BASE.items() if k != "pairs"})
          + "SELECT horizon, round(avg(predicted), 6) AS pred_mean, round(stddev_samp(predicted), 6) AS pred_std FROM pl GROUP BY horizon")
def a10_prediction_spread(spark, sf_dir):
    return round_cols(EV.prediction_spread(_base(spark, sf_dir)[2]), ["pred_mean", "pred_std"])


@register("a11_run_summary", Q.ctes(v3=Q.V3, act=ACT)
          + "SELECT city, min(date) AS first_date, max(date) AS last_date, count(*) AS n_rows FROM act GROUP BY city")
def a11_run_summary(spark, sf_dir):
    return EV.run_summary(V.daily_actuals(spark, sf_dir), key="city")


_LINE = ("SELECT city, prediction_date, step, date, aqi, aqi * (1 - f) AS lower, aqi * (1 + f) AS upper FROM ("
         "SELECT *, CASE step WHEN 2 THEN 0.15 WHEN 3 THEN 0.25 END AS f FROM ("
         "SELECT city, prediction_date, 0 AS step, latest_date AS date, latest_aqi AS aqi FROM preds UNION ALL "
         + " UNION ALL ".join(f"SELECT city, prediction_date, {h}, prediction_date + {h - 1}, p{h} FROM preds" for h in (1, 2, 3))
         + "))")


@register("w20_forecast_line", Q.ctes(v3=Q.V3, act=ACT, preds=PREDS, line=_LINE)
          + "SELECT city, prediction_date, step, date, round(aqi, 6) AS aqi, round(lower, 6) AS lower, round(upper, 6) AS upper FROM line")
def w20_forecast_line(spark, sf_dir):
    return round_cols(EV.forecast_line(_base(spark, sf_dir)[1]), ["aqi", "lower", "upper"])


@register("w17_step_changes", Q.ctes(v3=Q.V3, act=ACT, preds=PREDS, line=_LINE)
          + "SELECT city, prediction_date, step, CAST(trunc(aqi) AS INTEGER) AS aqi_int, "
            "CAST(trunc(aqi) AS INTEGER) - lag(CAST(trunc(aqi) AS INTEGER)) OVER (PARTITION BY city, prediction_date ORDER BY step) AS delta FROM line")
def w17_step_changes(spark, sf_dir):
    return EV.step_changes(EV.forecast_line(_base(spark, sf_dir)[1]))


_SEV = "CASE label " + " ".join(f"WHEN '{b[2]}' THEN {k}" for k, b in enumerate(C.AQI_BANDS)) + " END"



@register("a20_worst_category", Q.ctes(**{k: v for k, v in BASE.items() if k != "pairs"})
          + f"SELECT city, prediction_date, arg_max(label, {_SEV}) AS worst_label, max({_SEV}) AS worst_severity "
            "FROM pl WHERE label IS NOT NULL GROUP BY city, prediction_date")
def a20_worst_category(spark, sf_dir):
    return EV.worst_category(_base(spark, sf_dir)[2])


# Scalars over raw event values (F04, F05, F07, F10, F12) -------------------
def _bands_sql(v: str) -> str:
    g = f"greatest(0.0, {v})"
    out = [f"{band_case(g, [b[k] for b in C.AQI_BANDS], C.AQI_FALLBACK[k])} AS {name}"
           for name, k in (("label", 2), ("low", 0), ("high", 1), ("bg_color", 3), ("text_color", 4))]
    parity = band_case(g, [b[2] for b in C.AQI_BANDS], C.AQI_FALLBACK[2], parity=True)
    return ", ".join([*out, f"{parity} AS parity_label"])


_ADV = ("CASE label " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in C.HEALTH_ADVICE.items())
        + f" ELSE '{C.HEALTH_ADVICE[C.HEALTH_ADVICE_DEFAULT]}' END")


@register("f04_f05_f07_f10_f12_scalars",
          f"SELECT event_id, value, label, low, high, bg_color, text_color, parity_label, {_ADV} AS advice, clamped, gauge_pct, int_trunc, int_round FROM ("
          f"SELECT event_id, value - 5.0 AS value, {_bands_sql('value - 5.0')}, greatest(0.0, value - 5.0) AS clamped, "
          "least(100.0, greatest(0.0, (value - 5.0) / 500.0 * 100.0)) AS gauge_pct, "
          "CAST(trunc(value - 5.0) AS INTEGER) AS int_trunc, CAST(round_even(value - 5.0, 0) AS INTEGER) AS int_round FROM events)")
def f04_scalars(spark, sf_dir):
    """Band, parity band, advice, clamp, gauge and integer display of every
    event value shifted by -5 (so negatives and band edges occur)."""
    e = V.table(spark, sf_dir, "events").select("event_id", (F.col("value") - 5.0).alias("value"))
    cat = S.aqi_category("value")
    return e.select("event_id", "value", cat["label"].alias("label"), cat["low"].alias("low"),
                    cat["high"].alias("high"), cat["bg_color"].alias("bg_color"),
                    cat["text_color"].alias("text_color"), S.aqi_label("value", parity=True).alias("parity_label"),
                    S.health_advice(cat["label"]).alias("advice"),
                    S.clamp_non_negative("value").alias("clamped"), S.gauge_pct("value").alias("gauge_pct"),
                    S.int_truncate("value").alias("int_trunc"), S.int_round_half_even("value").alias("int_round"))


@register("f01_f02_f03_f13_calendar",
          "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date, CAST(isodow(o_orderdate) - 1 AS INTEGER) AS dow, "
          "round(sin(2 * pi() * month(o_orderdate) / 12.0), 6) AS month_sin, round(cos(2 * pi() * month(o_orderdate) / 12.0), 6) AS month_cos, "
          "strftime(o_orderdate, '%d %b %Y') AS day_short, strftime(o_orderdate, '%-d %B %Y') AS day_long FROM orders")
def f01_calendar(spark, sf_dir):
    o = V.table(spark, sf_dir, "orders")
    d = S.day_of("o_orderdate")
    out = o.select("o_orderkey", d.alias("date"))
    return round_cols(out.select("o_orderkey", "date", S.dow_monday0("date").alias("dow"),
                                 S.month_sin("date").alias("month_sin"), S.month_cos("date").alias("month_cos"),
                                 S.fmt_day_short("date").alias("day_short"), S.fmt_day_long("date").alias("day_long")),
                      ["month_sin", "month_cos"])
