"""Profiling queries (C09) over the daily feature table of the long series."""
from __future__ import annotations

from pyspark.sql import functions as F

from airlens import constants as C
from airlens.modeling import moments as MO
from airlens.operators import features as FE
from airlens.operators import profile as PR
from airlens.operators import rollup as RU
from airlens.plans import sqlparts as Q
from airlens.plans.base import FEATURE_OUT, register, round_cols
from airlens.session import cut_lineage
from airlens.sources import standins as V

FULL = Q.ctes(v3=Q.V3, d=Q.daily("v3"), f=Q.features("d"))
COMPLETE = Q.ctes(v3=Q.V3, d=Q.daily("v3"), f0=Q.features("d"),
                  f=f"SELECT * FROM f0 WHERE {Q.not_null(sorted(set(C.FEATURE_COLS + C.TARGETS)))}")
PROFILED = [c for c in FEATURE_OUT if c not in ("city", "date")]
CORR_SET = ["aqi_mean", "pm2_5_mean", "temp_mean", "humidity_mean", "wind_mean", "pressure_mean", "aqi_day1"]


def features_full(spark, sf_dir, cols=None):
    """Daily features before any row is dropped (nulls at series ends), only
    ``cols`` where given.  Materialised once: the daily grain is what a
    feature store holds, and downstream plans read it in several branches."""
    f = FE.add_daily_features(RU.daily_rollup(V.lineitem_readings(spark, sf_dir)))
    return cut_lineage(f if cols is None else f.select(*dict.fromkeys(cols)))


def features_complete(spark, sf_dir, cols=None):
    """The feature table (complete rows), materialised once (see above)."""
    f = FE.compute_features(V.lineitem_readings(spark, sf_dir))
    return cut_lineage(f if cols is None else f.select(*dict.fromkeys(cols)))


@register("a07_t06_null_counts", FULL + " UNION ALL ".join(
    f"SELECT * FROM (SELECT '{c}' AS \"column\", CAST(count_if({c} IS NULL) AS BIGINT) AS n_null FROM f) WHERE n_null > 0" for c in FEATURE_OUT))
def a07_null_counts(spark, sf_dir):
    return PR.null_counts(features_full(spark, sf_dir))


def _r(e):
    return f"round({e}, 6)"


@register("a13_describe", COMPLETE + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS count, {_r(f'avg({c})')} AS mean, {_r(f'stddev_samp({c})')} AS std, "
    f"{_r(f'min({c})')} AS min, {_r(f'quantile_cont({c}, 0.25)')} AS q25, {_r(f'quantile_cont({c}, 0.5)')} AS q50, "
    f"{_r(f'quantile_cont({c}, 0.75)')} AS q75, {_r(f'max({c})')} AS max FROM f" for c in PROFILED))
def a13_describe(spark, sf_dir):
    d = PR.describe(features_complete(spark, sf_dir, PROFILED), PROFILED)
    return round_cols(d, ["mean", "std", "min", "q25", "q50", "q75", "max"])


def _corr_sql(xs, ys):
    return " UNION ALL ".join(
        f"SELECT '{a}' AS feature, '{b}' AS target, round(CASE WHEN isnan(corr({a}, {b})) THEN NULL ELSE corr({a}, {b}) END, 6) AS corr FROM f"
        for a in xs for b in ys)


@register("p12_p13_p14_column_roles", COMPLETE + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{r}' AS role, {n} AS n_values FROM f" for c, r, n in
    [(c, "target" if c in C.TARGETS else "feature" if c in C.FEATURE_COLS else "other", f"count({c})") for c in FEATURE_OUT if c != "wind_max"]
    + [("seen_day2", "horizon", "count(*)"), ("pred_day1", "other", "count(*)")]
    + [(c, "missing", "CAST(0 AS BIGINT) * count(*)") for c in C.FEATURE_COLS if c == "wind_max"]))
def p12_column_roles(spark, sf_dir):
    """The feature table, one listed feature taken away, one suspicious and
    one allowed column added: every column's role."""
    f = features_complete(spark, sf_dir, FEATURE_OUT).drop("wind_max")
    return FE.column_roles(f.withColumns({"seen_day2": F.col("aqi_mean"), "pred_day1": F.col("aqi_mean")}), "aqi_day1")


@register("p15_absent_feature", COMPLETE + "SELECT city, date, 0.0::DOUBLE AS wind_max, aqi_mean FROM f")
def p15_absent_feature(spark, sf_dir):
    """A feature that is absent when scoring counts as 0."""
    from airlens.modeling import models as MD
    f = features_complete(spark, sf_dir, ["city", "date", "aqi_mean"])
    return MD.impute(f, ["wind_max", "aqi_mean"], {})


@register("a13_shape", COMPLETE + "SELECT count(*) AS n_rows, 58 AS n_columns FROM f")
def a13_shape(spark, sf_dir):
    return PR.shape(features_complete(spark, sf_dir, FEATURE_OUT)).drop("types")


@register("a14_feature_target_corr", COMPLETE + _corr_sql(C.FEATURE_COLS, C.TARGETS))
def a14_feature_target_corr(spark, sf_dir):
    return round_cols(PR.correlations(features_complete(spark, sf_dir, C.FEATURE_COLS + C.TARGETS), C.FEATURE_COLS, C.TARGETS), ["corr"])


@register("t06_ranked_correlations", COMPLETE + "SELECT feature, target, corr, CAST(row_number() OVER (PARTITION BY target "
          "ORDER BY abs(corr) DESC NULLS LAST, feature) AS INTEGER) AS rank FROM ("
          + _corr_sql(C.FEATURE_COLS, C.TARGETS) + ")")
def t06_ranked_correlations(spark, sf_dir):
    """Features by the size of their correlation with each target."""
    f = features_complete(spark, sf_dir, C.FEATURE_COLS + C.TARGETS)
    return PR.ranked_correlations(round_cols(PR.correlations(f, C.FEATURE_COLS, C.TARGETS), ["corr"]))


@register("a15_corr_matrix", COMPLETE + _corr_sql(CORR_SET, CORR_SET))
def a15_corr_matrix(spark, sf_dir):
    return round_cols(PR.correlations(features_complete(spark, sf_dir, CORR_SET), CORR_SET), ["corr"])


@register("a15_corr_one_pass", COMPLETE + _corr_sql(C.FEATURE_COLS + C.TARGETS, C.FEATURE_COLS + C.TARGETS))
def a15_corr_one_pass(spark, sf_dir):
    """The whole matrix of features and targets from one pass."""
    cols = C.FEATURE_COLS + C.TARGETS
    return round_cols(MO.correlation_table(features_complete(spark, sf_dir, cols), cols), ["corr"])


@register("a16_histogram", COMPLETE
          + "SELECT CAST(least(floor(20.0 * (aqi_mean - lo) / (hi - lo)) + 1, 20) AS INTEGER) AS bucket, count(*) AS n, "
            "round(any_value(lo) + (CAST(least(floor(20.0 * (aqi_mean - lo) / (hi - lo)) + 1, 20) AS INTEGER) - 1) * any_value(w), 6) AS lower, "
            "round(any_value(lo) + CAST(least(floor(20.0 * (aqi_mean - lo) / (hi - lo)) + 1, 20) AS INTEGER) * any_value(w), 6) AS upper "
            "FROM f, (SELECT min(aqi_mean) AS lo, max(aqi_mean) AS hi, (max(aqi_mean) - min(aqi_mean)) / 20 AS w FROM f) s "
            "WHERE aqi_mean IS NOT NULL GROUP BY 1")
def a16_histogram(spark, sf_dir):
    return round_cols(PR.histogram(features_complete(spark, sf_dir, ["aqi_mean"]), "aqi_mean", 20), ["lower", "upper"])


@register("a17_density", COMPLETE
          + "SELECT CAST(i AS INTEGER) AS point, round(lo + i * st, 6) AS x, "
            "round(sum(exp(-0.5 * ((lo + i * st - aqi_mean) / bw) * ((lo + i * st - aqi_mean) / bw))) / sqrt(2 * pi()) / (n * bw), 6) AS density "
            "FROM f, (SELECT min(aqi_mean) AS lo, (max(aqi_mean) - min(aqi_mean)) / 49 AS st, CAST(count(aqi_mean) AS DOUBLE) AS n, "
            "stddev_samp(aqi_mean) * pow(CAST(count(aqi_mean) AS DOUBLE), -0.2) AS bw FROM f) s, range(50) g(i) "
            "WHERE aqi_mean IS NOT NULL GROUP BY i, lo, st, n, bw")
def a17_density(spark, sf_dir):
    return round_cols(PR.density(features_complete(spark, sf_dir, ["aqi_mean"]), "aqi_mean", 50), ["x", "density"])


def _box_sql(by: str | None):
    g = f"{by}, " if by else ""
    on = f"USING ({by})" if by else "ON TRUE"
    return (f"SELECT {g}round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, round(q3 - q1, 6) AS iqr, "
            "round(min(CASE WHEN x >= q1 - 1.5 * (q3 - q1) THEN x END), 6) AS whisker_low, "
            "round(max(CASE WHEN x <= q3 + 1.5 * (q3 - q1) THEN x END), 6) AS whisker_high, "
            "CAST(count_if(x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)) AS BIGINT) AS n_outliers, count(*) AS n "
            f"FROM (SELECT {g}aqi_mean AS x FROM f WHERE aqi_mean IS NOT NULL) t JOIN "
            f"(SELECT {g}quantile_cont(aqi_mean, 0.25) AS q1, quantile_cont(aqi_mean, 0.5) AS median, "
            f"quantile_cont(aqi_mean, 0.75) AS q3 FROM f WHERE aqi_mean IS NOT NULL {'GROUP BY ' + by if by else ''}) q {on} "
            f"GROUP BY {g}q1, median, q3")


BOX_ROUND = ["q1", "median", "q3", "iqr", "whisker_low", "whisker_high"]


@register("a18_box_stats", COMPLETE + _box_sql(None))
def a18_box_stats(spark, sf_dir):
    return round_cols(PR.box_stats(features_complete(spark, sf_dir, ["aqi_mean"]), "aqi_mean"), BOX_ROUND)


@register("a19_box_by_dow", COMPLETE + _box_sql("dow"))
def a19_box_by_dow(spark, sf_dir):
    return round_cols(PR.box_stats(features_complete(spark, sf_dir, ["aqi_mean", "dow"]), "aqi_mean", by="dow"), BOX_ROUND)
