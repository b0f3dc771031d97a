"""Attribution queries (V5: fixed linear weights on the daily feature table)."""
from __future__ import annotations

from airlens.operators import explain as EX
from airlens.plans.base import register, round_cols
from airlens.plans.q_profile import COMPLETE, features_complete

# Query parameters: a linear model per horizon (weights, intercept).
WEIGHTS = {
    1: {"aqi_lag1d": 0.55, "aqi_roll_mean_3": 0.25, "aqi_roll_mean_7": 0.1, "temp_mean": -30.0,
        "humidity_mean": 40.0, "wind_mean": -0.4, "fc_temp_d1": 20.0, "aqi_std_7d": 0.15},
    2: {"aqi_lag1d": 0.35, "aqi_roll_mean_3": 0.3, "aqi_roll_mean_7": 0.2, "temp_mean": -20.0,
        "humidity_mean": 25.0, "wind_mean": -0.7, "fc_temp_d2": 25.0, "aqi_std_7d": 0.3},
    3: {"aqi_lag1d": 0.2, "aqi_roll_mean_3": 0.3, "aqi_roll_mean_7": 0.35, "temp_mean": -10.0,
        "humidity_mean": 10.0, "wind_mean": -1.1, "fc_temp_d3": 30.0, "aqi_std_7d": 0.45},
}
INTERCEPTS = {1: 2.0, 2: 4.0, 3: 6.0}
FEATS = sorted({f for w in WEIGHTS.values() for f in w})


def explained(spark, sf_dir):
    return EX.explanations(features_complete(spark, sf_dir, ["city", "date", *FEATS]), WEIGHTS, INTERCEPTS)


def _contrib_sql() -> str:
    means = ", ".join(f"avg({f}) AS m_{f}" for f in FEATS)
    parts = []
    for h, w in sorted(WEIGHTS.items()):
        base = f"{float(INTERCEPTS[h])}" + "".join(f" + {float(v)} * m_{f}" for f, v in w.items())
        for f, v in sorted(w.items()):
            parts.append(f"SELECT city, date, {h} AS horizon, '{f}' AS feature, CAST({f} AS DOUBLE) AS x, "
                         f"{float(v)} * ({f} - m_{f}) AS shap_value, {base} AS base_value FROM f, (SELECT {means} FROM f) m")
    return " UNION ALL ".join(parts)


CONTRIB = COMPLETE.rstrip("\n") + f",\nc AS ({_contrib_sql()}),\n" \
    "r AS (SELECT *, row_number() OVER (PARTITION BY city, date, horizon ORDER BY abs(shap_value) DESC, feature) AS rank FROM c)\n"


@register("m12_linear_contributions", CONTRIB + "SELECT city, date, horizon, feature, round(x, 6) AS x, round(shap_value, 6) AS shap_value, "
          "round(base_value, 6) AS base_value FROM c")
def m12_linear_contributions(spark, sf_dir):
    return round_cols(EX.contributions(explained(spark, sf_dir)), ["x", "shap_value", "base_value"])


@register("m16_base_value", CONTRIB + "SELECT horizon, round(avg(bv + s), 6) AS base_value FROM "
          "(SELECT city, date, horizon, any_value(base_value) AS bv, sum(shap_value) AS s FROM c GROUP BY ALL) GROUP BY horizon")
def m16_base_value(spark, sf_dir):
    """Mean prediction over the background equals the base value (linear)."""
    preds = EX.predictions_from_contributions(explained(spark, sf_dir))
    return round_cols(EX.base_values(preds), ["base_value"])


@register("t02_t04_top_contributions", CONTRIB + "SELECT city, date, horizon, feature, round(x, 6) AS x, round(shap_value, 6) AS shap_value, "
          "round(base_value, 6) AS base_value, CAST(rank AS INTEGER) AS rank, round(abs(shap_value), 6) AS abs_shap FROM r WHERE rank <= 3")
def t02_top_contributions(spark, sf_dir):
    return round_cols(EX.top_contributions(explained(spark, sf_dir), 3), ["x", "shap_value", "base_value", "abs_shap"])


_WF = ("SELECT city, date, horizon, CAST(rank AS INTEGER) AS rank, feature, round(shap_value, 6) AS shap_value, round(base_value, 6) AS base_value, "
       "round(base_value + sum(shap_value) OVER (PARTITION BY city, date, horizon ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS running_total "
       "FROM (SELECT city, date, horizon, rank, feature, shap_value, base_value FROM r WHERE rank <= 4 UNION ALL "
       "SELECT city, date, horizon, 5, 'other features', sum(shap_value), any_value(base_value) FROM r WHERE rank > 4 "
       "GROUP BY city, date, horizon HAVING abs(sum(shap_value)) > 0.01)")


@register("m17_u03_p17_w16_waterfall", CONTRIB + _WF)
def m17_waterfall(spark, sf_dir):
    return round_cols(EX.waterfall(explained(spark, sf_dir), 4), ["shap_value", "base_value", "running_total"])


@register("f14_insight", CONTRIB + "SELECT city, date, horizon, 'For day ' || CAST(horizon AS VARCHAR) || ': ' || "
          "string_agg(printf('%s %s %.1f AQI points', feature, CASE WHEN shap_value > 0 THEN 'pushed the forecast up by' "
          "ELSE 'reduced it by' END, abs(shap_value)), ', and ' ORDER BY rank) || '.' AS insight FROM r WHERE rank <= 3 "
          "GROUP BY city, date, horizon")
def f14_insight(spark, sf_dir):
    return EX.insight(explained(spark, sf_dir), 3)


@register("j06_u04_align_top_features", CONTRIB
          + "SELECT city, date, feature, " + ", ".join(
              f"round(coalesce(max(CASE WHEN horizon = {h} THEN shap_value END), 0.0), 6) AS day{h}" for h in (1, 2, 3))
          + " FROM c WHERE (city, date, feature) IN (SELECT city, date, feature FROM r WHERE rank <= 2) GROUP BY city, date, feature")
def j06_align_top_features(spark, sf_dir):
    return round_cols(EX.align_top_features(explained(spark, sf_dir), 2), ["day1", "day2", "day3"])
