"""Cleaning: gap filling, de-duplication, range nulling (hand-derived answers)."""
import datetime as dt
import random

import pandas as pd
import pytest

from airlens.operators import clean as CL

T0 = dt.datetime(2024, 1, 1)


def _series(spark, values, key="k", step_hours=1):
    rows = [(key, T0 + dt.timedelta(hours=i * step_hours), None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "city string, timestamp timestamp_ntz, x double")


def _fill(spark, values, bucket="year", step_hours=1):
    df = _series(spark, values, step_hours=step_hours)
    out = CL.fill_gaps(df, "city", "timestamp", ["x"], limit=3, bucket=bucket).orderBy("timestamp")
    return [r.x for r in out.collect()]


@pytest.mark.parametrize("bucket,step", [("year", 1), ("day", 1), ("day", 7)])
def test_long_gap(spark, bucket, step):
    vals = [None, None, 0, None, None, None, None, None, 6, None, None, None, None, None]
    assert _fill(spark, vals, bucket, step) == [0, 0, 0, 1, 2, 3, 3, 3, 6, 6, 6, 6, 6, 6]


def test_short_and_leading_gap(spark):
    assert _fill(spark, [1, None, None, 4]) == [1, 2, 3, 4]
    assert _fill(spark, [None, None, 5]) == [5, 5, 5]


def test_all_null_stays_null(spark):
    assert _fill(spark, [None, None, None]) == [None, None, None]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_gap_fill_matches_pandas(spark, seed):
    rnd = random.Random(seed)
    vals = [None if rnd.random() < 0.6 else round(rnd.uniform(0, 100), 2) for _ in range(120)]
    expected = pd.Series(vals, dtype="float64").interpolate(method="linear", limit=3).ffill().bfill().tolist()
    for bucket, step in (("year", 1), ("day", 5)):
        got = _fill(spark, vals, bucket, step)
        assert got == pytest.approx(expected, abs=1e-9)


def test_dedupe_keep_first_and_last(spark):
    df = spark.createDataFrame([("k", T0, 1, 10.0), ("k", T0, 2, 20.0), ("k", T0 + dt.timedelta(hours=1), 1, 5.0)],
                               "city string, timestamp timestamp_ntz, seq int, aqi double")
    first = {r.timestamp: r.seq for r in CL.dedupe(df, ["city", "timestamp"], ["seq"], "first").collect()}
    last = {r.timestamp: r.seq for r in CL.dedupe(df, ["city", "timestamp"], ["seq"], "last").collect()}
    assert first[T0] == 1 and last[T0] == 2 and len(first) == 2


def test_fresh_rows_win(spark):
    hist = spark.createDataFrame([("k", T0, 9, 1.0)], "city string, timestamp timestamp_ntz, seq int, aqi double")
    fresh = spark.createDataFrame([("k", T0, 1, 2.0)], "city string, timestamp timestamp_ntz, seq int, aqi double")
    out = CL.keep_latest_version(hist, fresh, ["city", "timestamp"], ["seq"]).collect()
    assert [r.aqi for r in out] == [2.0]


def test_range_null_inclusive(spark):
    df = spark.createDataFrame([(0.0, 500.0, -15.0), (-0.1, 500.1, 45.1)], "aqi double, pm2_5 double, temperature double")
    rows = CL.null_out_of_range(df).collect()
    assert tuple(rows[0]) == (0.0, 500.0, -15.0)
    assert tuple(rows[1]) == (None, None, None)
    counts = {r.column: r.n_out_of_range for r in CL.out_of_range_counts(df).collect()}
    assert counts == {"aqi": 1, "pm2_5": 1, "temperature": 1}
