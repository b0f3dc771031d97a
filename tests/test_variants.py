"""Load accounts by file, variants by time, touched days, unseen chains, moments."""
import datetime as dt
import gzip
import importlib
import math
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from airlens import constants as C
from airlens.modeling import models as MD
from airlens.modeling import moments as MO
from airlens.modeling.selection import expanding_folds
from airlens.operators import clean as CL
from airlens.operators import features as FE
from airlens.operators import profile as PR
from airlens.operators import rollup as RU
from airlens.sinks import store as ST
from airlens.sources import feeds as SRC
from airlens.streaming import jobs as SJ

D0 = dt.date(2024, 1, 1)


# -- files -------------------------------------------------------------------
def land(spark, path, names, fmt):
    for k, name in enumerate(names):
        rows = [("a", dt.datetime(2024, 1, 1 + k, h), *[float(h)] * len(C.AQ_VARIABLES)) for h in range(k + 1)]
        spark.createDataFrame(rows, SRC.AQ_SCHEMA).coalesce(1).write.format(fmt).save(f"{path}/day={name}")


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_one_broken_file_of_many(spark, tmp_path, fmt):
    path = tmp_path / "in"
    land(spark, path, range(12), fmt)
    rows, account = SRC.load_files(spark, str(path), SRC.AQ_SCHEMA, fmt)
    assert rows.count() == 78 and account.where("error is not null").count() == 0 and account.count() == 12
    bad = path / "day=4" / ("part-bad.parquet" if fmt == "parquet" else "part-bad.json.gz")
    bad.write_bytes(b"this is neither" * 10)
    rows, account = SRC.load_files(spark, str(path), SRC.AQ_SCHEMA, fmt)
    got = {r["file"].rsplit("/", 2)[-2] + "/" + r["file"].rsplit("/", 1)[-1][:8]: (r.n_rows, r.error) for r in account.collect()}
    assert rows.count() == 78 and len(got) == 13 and "day" in rows.columns
    assert got["day=4/part-bad"][0] is None and got["day=4/part-bad"][1]
    assert sum(n or 0 for n, _ in got.values()) == 78 and sum(e is not None for _, e in got.values()) == 1


def test_a_file_that_breaks_half_way_gives_no_rows(spark, tmp_path):
    path = tmp_path / "in"
    land(spark, path, range(3), "json")
    whole = gzip.compress(b'{"city": "a", "pm10": 1.0}\n' * 200_000)
    (path / "day=1" / "half.json.gz").write_bytes(whole[:len(whole) // 2])
    rows, account = SRC.load_files(spark, str(path), SRC.AQ_SCHEMA, "json")
    assert rows.count() == 6 and account.where("error is not null and n_rows is null").count() == 1


def test_records_that_cannot_be_read_are_counted(spark, tmp_path):
    path = tmp_path / "in"
    land(spark, path, range(2), "json")
    (path / "day=0" / "x.json").write_text('{"city": "b", "pm10": 2.0}\n{"city": \n')
    (path / "day=1" / "empty.json").write_text("")
    rows, account = SRC.load_files(spark, str(path), SRC.AQ_SCHEMA, "json")
    by = {r["file"].rsplit("/", 1)[-1]: r for r in account.collect()}
    assert (by["x.json"].n_rows, by["x.json"].n_bad) == (1, 1) and "1 unreadable" in by["x.json"].error
    assert "empty.json" not in by and rows.count() == 4


def test_no_file_and_no_good_file_are_errors(spark, tmp_path):
    with pytest.raises(Exception):
        SRC.load_files(spark, str(tmp_path / "nothing"), SRC.AQ_SCHEMA)
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "a.parquet").write_bytes(b"no")
    with pytest.raises(RuntimeError):
        SRC.load_files(spark, str(tmp_path / "p"), SRC.AQ_SCHEMA, "parquet")


def test_failures_without_a_message_are_account_rows(spark):
    def load(start, end):
        if start.month == 2:
            raise TimeoutError()
        return spark.range(3)
    rows, account = SRC.load_chunks(spark, "2024-01-01", "2024-03-10", load, 31)
    assert rows.count() == 6 and [r.error for r in account.orderBy("chunk_id").collect()] == [None, "TimeoutError", None]


# -- by time -----------------------------------------------------------------
def daily(spark, days):
    rows = [("k", D0 + dt.timedelta(days=d), float(d), *[1.0] * 6) for d in days]
    cols = "aqi_mean, pm2_5_mean, pm10_mean, temp_mean, pressure_mean, wind_mean, humidity_mean".split(", ")
    return spark.createDataFrame(rows, "city string, date date, " + ", ".join(f"{c} double" for c in cols)).withColumn("precip_sum", F.lit(0.0))


def test_lag_seven_is_seven_days(spark):
    days = daily(spark, [0, 1, 2, 4, 7, 8, 9, 11])
    by_row = {r.date: r for r in FE.add_daily_features(days).collect()}
    by_day = {r.date: r for r in FE.add_daily_features(days, densify=True).collect()}
    at = lambda n: D0 + dt.timedelta(days=n)
    assert by_row[at(11)].aqi_lag7d == 0.0 and by_day[at(11)].aqi_lag7d == 4.0 and by_day[at(8)].aqi_lag7d == 1.0
    assert by_row[at(4)].aqi_lag1d == 2.0 and by_day[at(4)].aqi_lag1d is None
    assert by_day[at(4)].aqi_roll_mean_3 == 1.5 and by_day[at(9)].aqi_day2 == 11.0 and by_day[at(9)].aqi_day1 is None
    assert len(by_day) == 8


def test_last_six_hours_and_last_six_rows(spark):
    rows = [("k", dt.datetime(2024, 1, 1, h), float(h)) for h in (0, 1, 2, 10, 14, 15)]
    r = spark.createDataFrame(rows, "city string, timestamp timestamp_ntz, aqi double").withColumn("date", F.to_date("timestamp"))
    assert RU.last_n_mean(r, "city", "timestamp", "aqi").first().aqi_last6h == 7.0
    assert RU.last_hours_mean(r, "city", "timestamp", "aqi").first().aqi_last6h == 13.0
    assert RU.daily_rollup(r.drop("date"), hours=2).first().aqi_last6h == 14.5


def test_angles_go_the_shorter_way(spark):
    d = [350.0, None, None, 20.0, None, 200.0, None, None]
    rows = [("k", dt.datetime(2024, 1, 1, h), v) for h, v in enumerate(d)] + [(None, dt.datetime(2024, 1, 1, 5), 7.0)]
    df = spark.createDataFrame(rows, "city string, timestamp timestamp_ntz, wind_direction double")
    got = {(r.city, r.timestamp.hour): r.wind_direction for r in CL.fill_gaps(df, "city", "timestamp", circular=["wind_direction"]).collect()}
    x = [math.degrees(math.atan2((1 - t) * math.sin(math.radians(350)) + t * math.sin(math.radians(20)),
                                 (1 - t) * math.cos(math.radians(350)) + t * math.cos(math.radians(20)))) % 360 for t in (1 / 3, 2 / 3)]
    assert got["k", 1] == pytest.approx(x[0]) and got["k", 2] == pytest.approx(x[1]) and 350 < got["k", 1] < 360
    assert got["k", 4] == 20.0  # opposite directions cancel out: the one before
    assert got["k", 7] == 200.0 and got[None, 5] == 7.0
    plain = {r.timestamp.hour: r.wind_direction for r in CL.fill_gaps(df.where("city = 'k'"), "city", "timestamp").collect()}
    assert plain[1] == pytest.approx(240.0)


# -- stream ------------------------------------------------------------------
def readings(spark, rows):
    return spark.createDataFrame([(c, t and dt.datetime(2024, 1, *t), s, v) for c, t, s, v in rows],
                                 "city string, timestamp timestamp_ntz, seq long, aqi double")


def test_late_rows_revisions_and_nulls_give_the_batch_result(spark, tmp_path):
    base, src = str(tmp_path / "b"), str(tmp_path / "in")
    parts = [[("a", (1, h), h, float(h)) for h in range(9)] + [(None, (1, 3), 1, 5.0)],
             [("a", (20, 1), 90, 7.0), ("a", (1, 3), 95, 100.0)],             # day 20, and a revision of day 1
             [("a", (2, 5), 96, 1.0), ("b", (19, 1), 97, 2.0), ("a", None, 98, 3.0)]]  # one late, one not, one without a time
    late = []
    for p in parts:
        readings(spark, p).write.mode("append").parquet(src)
        late.append(SJ.stream_touched_days(spark, src, readings(spark, p).schema, base, f"{base}/c"))
    assert late == [0, 0, 1] and spark.read.parquet(f"{base}/late").count() == 1
    every = readings(spark, [r for p in parts for r in p])
    best = CL.dedupe(every, ["city", "timestamp"], ["seq"], keep="last").where("timestamp is not null")
    key = lambda rows: sorted(((r.city, r.date, r.aqi_mean, r.aqi_max, r.aqi_last6h) for r in rows), key=repr)
    assert key(ST.read_table(spark, f"{base}/daily").collect()) == key(RU.daily_rollup(best).collect())
    seen = {r.batch: (r.n_rows, r.n_late) for r in ST.read_table(spark, f"{base}/batches").collect()}
    assert sorted(seen.values()) == [(2, 0), (3, 1), (10, 0)]
    assert ST.read_table(spark, f"{base}/readings").count() == best.count() + 1


def test_late_rows_of_many_batches_are_counted(spark, tmp_path):
    at = [str(tmp_path / x) for x in ("in", "t", "c")]
    old = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates", "100")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "1")
    try:
        late = 0
        for k, day in enumerate((20, 1, 2, 3)):
            r = spark.createDataFrame([("a", dt.datetime(2024, 1, day, 1), 1.0, 1.0)] * 2, "city string, timestamp timestamp_ntz, aqi double, precipitation double")
            r.coalesce(1).write.mode("append").parquet(at[0])
            late += SJ.stream_daily_rollup(spark, at[0], r.schema, at[1], at[2])
        assert late >= 3 and ST.read_table(spark, at[1]).count() == 1
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", old)


# -- models ------------------------------------------------------------------
def table(spark, n=120, change=None):
    rnd = np.random.RandomState(4)
    x, z, noise = rnd.normal(size=n) * 40 + 1000, rnd.normal(size=n), rnd.normal(size=n)
    rows = [("ab"[k % 2], D0 + dt.timedelta(days=k // 2), float(x[k]), None if k % 11 == 0 else float(z[k]), 5.0,
             999.0 if k == change else float(x[k] * 0.5 + z[k] * 3 + noise[k]), float(x[k] * 0.1)) for k in range(n)]
    return spark.createDataFrame(rows, "city string, date date, aqi_mean double, temp_mean double, wind_max double, aqi_day1 double, aqi_day2 double")


def test_own_target_does_not_reach_the_chained_feature(spark):
    names, grid = ["aqi_mean", "temp_mean"], {"ridge": [{"alpha": 1.0}]}
    run = lambda change, how: {(r.city, r.date): r.pred_day1 for r in MD.train_chain(
        table(spark, change=change), names, grid, targets=["aqi_day1"], chained=how)[1].collect()}
    k = 60
    row = ("ab"[k % 2], D0 + dt.timedelta(days=k // 2))
    seen, unseen = [run(c, "in_sample") for c in (None, k)], [run(c, "out_of_fold") for c in (None, k)]
    assert seen[0][row] != seen[1][row] and unseen[0][row] == pytest.approx(unseen[1][row], abs=1e-9)
    assert any(abs(unseen[0][r] - unseen[1][r]) > 1e-6 for r in unseen[0]) and len(unseen[0]) == 120
    with pytest.raises(ValueError):
        MD.train_chain(table(spark), names, grid, chained="other")


def test_moment_scores_equal_fitted_ones(spark):
    f = table(spark)
    names = ["aqi_mean", "temp_mean", "wind_max"]
    means = MD.fit_means(f, names)
    got = MO.ridge_cv(f, names, "aqi_day1", means, [0.5, 10.0])
    folds = expanding_folds(f)
    for alpha, scores in got.items():
        want = MD.cv_score(folds, names, "aqi_day1", "ridge", {"alpha": alpha}, means)
        assert np.mean(scores) == pytest.approx(want, rel=1e-7)


def test_one_pass_correlations_equal_pandas(spark):
    f = table(spark)
    cols = ["aqi_mean", "temp_mean", "wind_max", "aqi_day1"]
    want = f.select(*cols).toPandas().corr()
    for r in MO.correlation_table(f, cols).collect():
        w = want.loc[r.feature, r.target]
        assert r["corr"] is None if np.isnan(w) else r["corr"] == pytest.approx(w, abs=1e-9)
    assert {r["corr"] for r in MO.correlation_table(f.limit(0), cols).collect()} == {None}


def test_describe_without_rows_and_with_nulls(spark):
    f = table(spark)
    got = {r.column: r for r in PR.describe(f, ["aqi_mean", "temp_mean", "wind_max"]).collect()}
    want = f.select("aqi_mean", "temp_mean", "wind_max").toPandas().describe()
    for c, r in got.items():
        for name, at in (("count", "count"), ("mean", "mean"), ("q25", "25%"), ("q50", "50%"), ("q75", "75%"), ("max", "max")):
            assert r[name] == pytest.approx(want.loc[at, c])
    none = PR.describe(f.limit(0), ["aqi_mean"]).first()
    assert none["count"] == 0 and none["q50"] is None
    plan = PR.describe(f, ["aqi_mean"])._jdf.queryExecution().toString()
    assert "percentile(" not in plan


@pytest.mark.parametrize("module", ["q_eval", "q_explain", "q_flows", "q_ml", "q_model", "q_profile", "q_sources", "q_store", "q_time"])
def test_query_modules_import_alone(module):
    assert importlib.import_module(f"airlens.plans.{module}")
    subprocess.run([sys.executable, "-c", f"import airlens.plans.{module}"], check=True)
