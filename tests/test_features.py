"""Rollup and feature semantics (hand-derived answers and properties)."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from airlens.functions import scalars as S
from airlens.operators import features as FE
from airlens.operators import rollup as RU

D0 = dt.date(2024, 1, 1)


def _daily(spark, values, col="aqi_mean"):
    rows = [("k", D0 + dt.timedelta(days=i), None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, f"city string, date date, {col} double")


def test_rolling_lagged_min_periods(spark):
    df = _daily(spark, [1, None, 3, 4, 5])
    w = FE.Frames(["city"], "date")
    out = df.select("date", FE.rolling_mean_lagged("aqi_mean", w, 3, 2).alias("r")).orderBy("date")
    assert [r.r for r in out.collect()] == [None, None, None, 2.0, 3.5]


def test_pct_change_zero_base_is_null(spark):
    df = _daily(spark, [10, 0, 5, 7])
    cols = dict(FE.lag_feature_columns(["city"], "date"))
    out = df.select("date", cols["aqi_pct_change"].alias("p")).orderBy("date").collect()
    assert out[2].p == pytest.approx(-100.0) and out[3].p is None


def test_std_n1_and_all_null_sum(spark):
    t = dt.datetime(2024, 1, 1, 5)
    df = spark.createDataFrame([("k", t, 7.0, None)], "city string, timestamp timestamp_ntz, aqi double, precipitation double")
    r = RU.daily_rollup(df, spec=[("aqi_std", "aqi", "std"), ("precip_sum", "precipitation", "sum")]).collect()[0]
    assert r.aqi_std == 0.0 and r.precip_sum == 0.0 and r.aqi_last6h == 7.0


def test_last6_mean_fewer_and_more_rows(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [("k", base + dt.timedelta(hours=h), float(v)) for h, v in enumerate([1, 2, 3])]
    rows += [("k", base + dt.timedelta(days=1, hours=h), float(h)) for h in range(10)]
    df = spark.createDataFrame(rows, "city string, timestamp timestamp_ntz, aqi double").withColumn("date", F.to_date("timestamp"))
    got = {r.date: r.aqi_last6h for r in RU.last_n_mean(df, "city", "timestamp", "aqi", 6).collect()}
    assert got[dt.date(2024, 1, 1)] == 2.0 and got[dt.date(2024, 1, 2)] == pytest.approx(6.5)


def test_dow_monday_zero(spark):
    r = spark.createDataFrame([(dt.date(2024, 1, 1),)], "d date").select(S.dow_monday0("d").alias("x")).first()
    assert r.x == 0


def test_lag_features_never_see_current_or_future(spark):
    vals = [float(i * 3 % 7) for i in range(20)]
    base = _daily(spark, vals)
    for c in ["pm2_5_mean", "pm10_mean", "temp_mean", "pressure_mean", "wind_mean", "humidity_mean"]:
        base = base.withColumn(c, F.col("aqi_mean") * 2)
    t = 12
    changed = base.withColumn("aqi_mean", F.when(F.col("date") >= D0 + dt.timedelta(days=t), F.col("aqi_mean") + 100)
                              .otherwise(F.col("aqi_mean")))
    lag_names = [n for n, _ in FE.lag_feature_columns(["city"], "date") if n not in ("month_sin", "month_cos", "dow")]
    def feats(df):
        out = df.select("date", *[c.alias(n) for n, c in FE.lag_feature_columns(["city"], "date") if n in lag_names])
        return {r.date: r for r in out.where(F.col("date") <= D0 + dt.timedelta(days=t)).collect()}
    a, b = feats(base), feats(changed)
    assert a == b


def test_last_row_override(spark):
    daily = _daily(spark, [1, 2, 3])
    for c in ["temp_mean", "humidity_mean", "wind_mean", "pressure_mean", "precip_sum", "pm2_5_mean", "pm10_mean"]:
        daily = daily.withColumn(c, F.lit(1.0))
    fc = spark.createDataFrame([("k", 21.5, None)], "city string, fc_temp_d1 double, fc_wind_d1 double")
    out = FE.add_daily_features(daily, targets=False, forecast=fc).orderBy("date").collect()
    assert [r.fc_temp_d1 for r in out] == [1.0, 1.0, 21.5]
    assert out[-1].fc_wind_d1 is None          # null forecast leaves the (null) lead


def test_leakage_guard():
    with pytest.raises(ValueError):
        FE.check_leakage(["aqi_mean", "aqi_day1"])
    with pytest.raises(ValueError):
        FE.check_leakage(["my_day2_thing"])
    assert FE.check_leakage(["pred_day1", "fc_temp_d1"]) == []
