"""Forecast-versus-actual evaluation (J02-J03, A08-A12, A20, W15, W17, W20,
F08-F11, P16, P18-P19, T03).

Predictions are melted to long form ``(key, prediction_date, horizon,
predicted)`` so all horizons go through **one** join with the actuals on
``(key, target_date)`` instead of one join per horizon.  Metrics are single
aggregations grouped by ``(key, horizon)`` with map-side partial aggregates.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airlens import constants as C
from airlens.functions import scalars as S
from airlens.operators.clean import _as_list

HORIZONS = (1, 2, 3)


# V4 stand-in -----------------------------------------------------------------
def persistence_predictions(actuals: DataFrame, key="city", date_col: str = "date") -> DataFrame:
    """Nested prediction documents: on each day, horizon ``h`` predicts the
    AQI seen ``h`` rows earlier (deterministic; used to exercise evaluation)."""
    keys = _as_list(key)
    w = Window.partitionBy(*keys).orderBy(date_col)
    days = []
    for h in HORIZONS:
        v = F.lag("aqi_mean", h).over(w)
        days.append(F.struct(v.alias("aqi"), S.aqi_label(v).alias("label")).alias(f"day{h}"))
    return actuals.select(*keys, F.col(date_col).alias("prediction_date"),
                          (F.col(date_col).cast("timestamp_ntz") + F.expr("INTERVAL 6 HOURS")).alias("predicted_at"),
                          *days,
                          F.lag(date_col, 1).over(w).alias("latest_date"),
                          F.lag("aqi_mean", 1).over(w).alias("latest_aqi"))


# P18 / J03 -------------------------------------------------------------------
def predictions_long(preds: DataFrame, key="city") -> DataFrame:
    """Nested day1..day3 structs -> (key, prediction_date, horizon, predicted, label).
    ``inline`` expands within the task; no shuffle."""
    keys = _as_list(key)
    arr = F.array(*[F.struct(F.lit(h).alias("horizon"), F.col(f"day{h}.aqi").alias("predicted"),
                             F.col(f"day{h}.label").alias("label")) for h in HORIZONS])
    return preds.select(*keys, "prediction_date", F.inline(arr))


def horizon_join(actuals: DataFrame, preds_long: DataFrame, key="city") -> DataFrame:
    """Actual on ``prediction_date + (horizon - 1)``; null pairs dropped."""
    keys = _as_list(key)
    p = preds_long.select(*keys, "horizon", "predicted",
                          F.date_add("prediction_date", F.col("horizon") - 1).alias("date"))
    a = actuals.select(*keys, "date", F.col("aqi_mean").alias("actual"))
    return a.join(p, keys + ["date"], "inner").dropna(subset=["actual", "predicted"])


# A08 / A09 -------------------------------------------------------------------
def regression_metrics(pairs: DataFrame, by=("horizon",), digits: int | None = 4) -> DataFrame:
    """RMSE, MAE, R^2 (``1 - SS_res / SS_tot``) in one aggregation;
    constant actuals give R^2 = 1 when the predictions are exact, else 0."""
    e = F.col("actual") - F.col("predicted")
    n = F.count(F.lit(1))
    ss_tot = F.var_pop("actual") * n
    out = pairs.groupBy(*_as_list(by)).agg(
        F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
        F.when(ss_tot > 0, F.lit(1.0) - F.try_divide(F.sum(e * e), ss_tot))
         .when(F.sum(e * e) == 0, 1.0).when(F.sum(e * e) > 0, 0.0).alias("r2"), n.alias("n"))
    return _round(out, ["rmse", "mae", "r2"], digits)


def live_metrics(pairs: DataFrame, by=("city", "horizon"), digits: int | None = 4) -> DataFrame:
    """Same metrics with guards: fewer than 2 pairs -> NULL metrics and
    n = 0; zero variance of actuals -> R^2 = 0."""
    e = F.col("actual") - F.col("predicted")
    n = F.count(F.lit(1))
    agg = pairs.groupBy(*_as_list(by)).agg(
        F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
        F.sum(e * e).alias("_ssr"), (F.var_pop("actual") * n).alias("_sst"), n.alias("_n"))
    ok = F.col("_n") >= 2
    out = agg.select(*_as_list(by),
                     F.when(ok, F.col("rmse")).alias("rmse"), F.when(ok, F.col("mae")).alias("mae"),
                     F.when(ok, F.when(F.col("_sst") > 0, F.lit(1.0) - F.col("_ssr") / F.col("_sst"))
                            .otherwise(F.lit(0.0))).alias("r2"),
                     F.when(ok, F.col("_n")).otherwise(F.lit(0)).cast("long").alias("n"))
    return _round(out, ["rmse", "mae", "r2"], digits)


def _round(df, cols, digits):
    if digits is None:
        return df
    return df.select(*[S.round_half_even(c, digits).alias(c) if c in cols else F.col(c) for c in df.columns])


# W15 -------------------------------------------------------------------------
def rolling_rmse(pairs: DataFrame, by=("city", "horizon"), window: int = 7,
                 min_periods: int = 3, min_rows: int = 7) -> DataFrame:
    """Rolling RMSE over the last ``window`` pairs including the current one;
    series with fewer than ``min_rows`` pairs are left out."""
    by = _as_list(by)
    w = Window.partitionBy(*by).orderBy("date")
    fr = w.rowsBetween(-(window - 1), 0)
    e2 = (F.col("actual") - F.col("predicted")) ** 2
    out = pairs.select(*by, "date", e2.alias("_e2"), F.count(F.lit(1)).over(Window.partitionBy(*by)).alias("_n"))
    return (out.where(F.col("_n") >= min_rows)
            .select(*by, "date", F.when(F.count("_e2").over(fr) >= min_periods,
                                        F.sqrt(F.avg("_e2").over(fr))).alias("rolling_rmse")))


# F11 -------------------------------------------------------------------------
def residuals(pairs: DataFrame, by=("city", "horizon")) -> DataFrame:
    r = S.residual("actual", "predicted")
    return pairs.select(*_as_list(by), "date", r.alias("residual"), (r > 0).alias("under_predicted"))


# J02 / F08 / F09 / T03 / P16 -------------------------------------------------
def day1_pairs(actuals: DataFrame, preds: DataFrame, key="city") -> DataFrame:
    """Actual of ``date`` with the day-1 prediction issued that date."""
    keys = _as_list(key)
    p = preds.select(*keys, F.col("prediction_date").alias("date"), F.col("day1.aqi").alias("pred_aqi"))
    a = actuals.select(*keys, "date", "aqi_mean")
    return a.join(p, keys + ["date"], "inner").dropna(subset=["pred_aqi"])


def error_table(pairs: DataFrame, key="city", latest: int | None = 14,
                actual: str = "aqi_mean", predicted: str = "pred_aqi") -> DataFrame:
    """F08/F09 (+T03): error, accuracy %, severity tier and display date;
    the newest ``latest`` rows per key (sorted by date, not by its text)."""
    keys = _as_list(key)
    err = S.forecast_error(predicted, actual)
    out = pairs.select(*keys, "date", F.col(actual).alias("actual"), F.col(predicted).alias("predicted"),
                       err.alias("error"), S.round_half_even(F.abs(err), 1).alias("abs_error"),
                       S.accuracy_pct(predicted, actual).alias("accuracy"),
                       S.error_tier(err).alias("tier"), S.fmt_day_short("date").alias("date_label"))
    if latest:
        w = Window.partitionBy(*keys).orderBy(F.col("date").desc())
        out = out.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= latest).drop("_rn")
    return out


def large_errors(pairs: DataFrame, threshold: float = C.LARGE_ERROR_THRESHOLD,
                 actual: str = "aqi_mean", predicted: str = "pred_aqi") -> DataFrame:
    """Pairs whose absolute error exceeds ``threshold``."""
    return pairs.where(F.abs(F.col(actual) - F.col(predicted)) > threshold)


# A12 -------------------------------------------------------------------------
def accuracy_summary(table: DataFrame, key="city") -> DataFrame:
    """Mean accuracy % and mean absolute error per key (Q12: both provided)."""
    return table.groupBy(*_as_list(key)).agg(F.avg("accuracy").alias("mean_accuracy"),
                                             F.avg("abs_error").alias("mean_abs_error"))


# A10 / A11 -------------------------------------------------------------------
def prediction_spread(preds_long: DataFrame, by=("horizon",)) -> DataFrame:
    return preds_long.groupBy(*_as_list(by)).agg(F.avg("predicted").alias("pred_mean"),
                                                 F.stddev_samp("predicted").alias("pred_std"))


def run_summary(df: DataFrame, date_col: str = "date", key=None) -> DataFrame:
    return df.groupBy(*_as_list(key)).agg(F.min(date_col).alias("first_date"),
                                          F.max(date_col).alias("last_date"),
                                          F.count(F.lit(1)).alias("n_rows"))


# W20 / W17 / A20 -------------------------------------------------------------
def forecast_line(preds: DataFrame, key="city") -> DataFrame:
    """Forecast path per run: step 0 = latest actual (``latest_date``,
    ``latest_aqi`` on the run row), steps 1..3 = day1..day3 at
    prediction_date + 0..2; band +-15 % (day 2) and +-25 % (day 3)."""
    keys = _as_list(key)
    j = preds
    pts = [F.struct(F.lit(0).alias("step"), F.col("latest_date").alias("date"), F.col("latest_aqi").alias("aqi"))]
    pts += [F.struct(F.lit(h).alias("step"), F.date_add("prediction_date", h - 1).alias("date"),
                     F.col(f"day{h}.aqi").alias("aqi")) for h in HORIZONS]
    out = j.select(*keys, "prediction_date", F.inline(F.array(*pts)))
    f = F.coalesce(*[F.when(F.col("step") == h, F.lit(v)) for h, v in C.FORECAST_BAND.items()])
    return out.select("*", (F.col("aqi") * (1 - f)).alias("lower"), (F.col("aqi") * (1 + f)).alias("upper"))


def step_changes(line: DataFrame, key="city") -> DataFrame:
    """Change between successive forecast values on truncated ints."""
    keys = _as_list(key)
    w = Window.partitionBy(*keys, "prediction_date").orderBy("step")
    v = S.int_truncate("aqi")
    return line.select(*keys, "prediction_date", "step", v.alias("aqi_int"),
                       (v - F.lag(v).over(w)).alias("delta"))


def worst_category(preds_long: DataFrame, key="city") -> DataFrame:
    """Most severe label over the horizons of each run."""
    keys = _as_list(key)
    return (preds_long.where(F.col("label").isNotNull())
            .groupBy(*keys, "prediction_date")
            .agg(F.max_by("label", S.category_severity("label")).alias("worst_label"),
                 F.max(S.category_severity("label")).alias("worst_severity")))
