"""Bands, rounding, splits, folds and the horizon shift."""
import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from airlens.functions import scalars as S
from airlens.modeling import selection as SE
from airlens.operators import evaluate as EV


def test_bands_default_and_parity(spark):
    vals = [-3.0, 50.0, 50.5, 51.0, 100.3, 500.0, 501.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v double")
    out = df.select("i", S.aqi_label("v").alias("d"), S.aqi_label("v", parity=True).alias("p")).orderBy("i").collect()
    assert [r.d for r in out] == ["Good", "Good", "Moderate", "Moderate", "Unhealthy (Sensitive)", "Hazardous", "Hazardous"]
    assert [r.p for r in out] == ["Good", "Good", "Hazardous", "Moderate", "Hazardous", "Hazardous", "Hazardous"]


def test_half_even_rounding(spark):
    r = spark.range(1).select(S.round_half_even(F.lit(0.25), 1).alias("a"), S.round_half_even(F.lit(2.5), 0).alias("b"),
                              S.round_half_even(F.lit(37.25) - F.lit(24.1), 1).alias("c")).first()
    assert (r.a, r.b) == (0.2, 2.0)
    assert r.c == float(np.round(37.25 - 24.1, 1))   # pandas/numpy semantics (Python's round gives 13.1)


def test_time_split_80_20(spark):
    df = spark.createDataFrame([("k", i) for i in range(1, 11)], "city string, date int")
    tr = sorted(r.date for r in SE.time_split(df).where("is_train").collect())
    assert tr == list(range(1, 9))


def test_expanding_folds(spark):
    df = spark.createDataFrame([("k", i) for i in range(1, 11)], "city string, date int")
    f = SE.expanding_folds(df).collect()
    tests = {k: sorted(r.date for r in f if r.fold == k and r.role == "test") for k in (1, 2, 3)}
    trains = {k: sorted(r.date for r in f if r.fold == k and r.role == "train") for k in (1, 2, 3)}
    assert tests == {1: [5, 6], 2: [7, 8], 3: [9, 10]}
    assert trains == {1: [1, 2, 3, 4], 2: list(range(1, 7)), 3: list(range(1, 9))}
    for k in (1, 2, 3):
        assert max(trains[k]) < min(tests[k])      # never trains on the future


def test_horizon_shift(spark):
    act = spark.createDataFrame([("k", dt.date(2024, 1, 12), 40.0)], "city string, date date, aqi_mean double")
    pl = spark.createDataFrame([("k", dt.date(2024, 1, 10), 3, 42.0)],
                               "city string, prediction_date date, horizon int, predicted double")
    r = EV.horizon_join(act, pl).collect()
    assert len(r) == 1 and r[0].actual == 40.0 and r[0].predicted == 42.0


def test_live_metric_guards(spark):
    one = spark.createDataFrame([("k", 1, 1.0, 2.0)], "city string, horizon int, actual double, predicted double")
    r = EV.live_metrics(one).first()
    assert r.rmse is None and r.n == 0
    flat = spark.createDataFrame([("k", 1, 5.0, 4.0), ("k", 1, 5.0, 6.0)], "city string, horizon int, actual double, predicted double")
    r = EV.live_metrics(flat).first()
    assert r.r2 == 0.0 and r.rmse == 1.0 and r.n == 2
