"""Upserts (replace / merge, idempotent) and attribution properties."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from airlens.operators import explain as EX
from airlens.plans.q_store import k02_save_raw
from airlens.sinks import store as ST


def _read(spark, path):
    return {r.k: (r.a, r.b) for r in spark.read.parquet(path).collect()}


def test_upsert_replace_and_merge(spark):
    old = spark.createDataFrame([(1, 1.0, 2.0), (2, 5.0, 6.0)], "k int, a double, b double")
    new = spark.createDataFrame([(1, 9.0), (3, 7.0)], "k int, a double")
    for mode, expect in (("replace", {1: (9.0, None), 2: (5.0, 6.0), 3: (7.0, None)}),
                         ("merge", {1: (9.0, 2.0), 2: (5.0, 6.0), 3: (7.0, None)})):
        p = ST.scratch_path(spark, "upsert-test")
        ST.upsert(old, p, "k")
        res = ST.upsert(new, p, "k", mode=mode, count=True)
        assert (res.inserted, res.updated) == (1, 1)
        assert _read(spark, p) == expect
        ST.upsert(new, p, "k", mode=mode)            # idempotent
        assert _read(spark, p) == expect


def test_upsert_touches_only_batch_partitions(spark):
    rows = [("c", dt.date(2024, m, 1), float(m)) for m in (1, 2, 3)]
    df = spark.createDataFrame(rows, "city string, date date, aqi_mean double")
    p = ST.scratch_path(spark, "features-test")
    ST.save_features(df, p)
    upd = spark.createDataFrame([("c", dt.date(2024, 2, 1), 20.0), ("c", dt.date(2024, 2, 2), 21.0)],
                                "city string, date date, aqi_mean double")
    ST.save_features(upd, p)
    got = {r.date: r.aqi_mean for r in spark.read.parquet(p).collect()}
    assert got == {dt.date(2024, 1, 1): 1.0, dt.date(2024, 2, 1): 20.0, dt.date(2024, 2, 2): 21.0, dt.date(2024, 3, 1): 3.0}


def test_empty_batch_writes_nothing(spark):
    p = ST.scratch_path(spark, "empty")
    empty = spark.createDataFrame([], "k int, a double")
    assert ST.upsert(empty, p, "k", count=True).inserted == 0


def test_duplicate_keys_rejected(spark):
    dup = spark.createDataFrame([(1, 1.0), (1, 2.0)], "k int, a double")
    with pytest.raises(ValueError):
        ST.upsert(dup, ST.scratch_path(spark, "dup"), "k")


def test_raw_readings_of_one_moment(spark, tmp_path):
    """k02: of several readings of one key the last delivered one is stored,
    in the history as in the batch that replaces it."""
    events = spark.sql("""SELECT * FROM VALUES (1L, 'A', timestamp_ntz'2024-01-20 01:00:00', 1.0D, 7L),
        (4L, 'A', timestamp_ntz'2024-01-20 01:00:00', 4.0D, 7L), (3L, 'A', timestamp_ntz'2024-01-20 01:00:00', 9.0D, 7L),
        (5L, 'B', timestamp_ntz'2024-01-26 01:00:00', 5.0D, 7L), (6L, 'B', timestamp_ntz'2024-01-26 01:00:00', 2.0D, 7L),
        (7L, NULL, NULL, 3.0D, 7L), (8L, NULL, NULL, 8.0D, 7L) AS e(event_id, event_type, ts, value, user_id)""")
    events.write.parquet(str(tmp_path / "events.parquet"))
    got = {r.city: (r.seq, r.aqi) for r in k02_save_raw(spark, str(tmp_path)).collect()}
    assert got == {"A": (4, round(4 / 1.09, 6)), "B": (1_000_000_006, round(2 / 1.09 + 1, 6)), None: (8, round(8 / 1.09, 6))}
    readings = events.selectExpr("event_type city", "ts timestamp", "event_id seq")
    with pytest.raises(ValueError):
        ST.save_raw(readings, str(tmp_path / "r"))


def test_linear_attribution_sums_to_prediction(spark):
    df = spark.createDataFrame([("k", dt.date(2024, 1, d), float(d), float(d * d % 5)) for d in range(1, 11)],
                               "city string, date date, a double, b double")
    w = {1: {"a": 2.0, "b": -1.5}}
    c = EX.linear_contributions(df, w, {1: 3.0})
    pred = EX.predictions_from_contributions(c).join(df, ["city", "date"])
    for r in pred.collect():
        assert r.prediction == pytest.approx(3.0 + 2.0 * r.a - 1.5 * r.b)
    wf = EX.waterfall(c, n=1).where("feature = 'other features'").count()
    assert wf >= 0


def test_stream_upsert_is_replay_safe(spark):
    """Replaying the same landed files through a fresh checkpoint, and
    revisions arriving before originals, leave the same table."""
    from airlens.streaming import jobs as SJ
    t0 = dt.datetime(2024, 1, 1)
    orig = spark.createDataFrame([("k", t0 + dt.timedelta(hours=h), h, float(h)) for h in range(5)],
                                 "city string, timestamp timestamp_ntz, seq long, aqi double")
    rev = orig.where("seq >= 3").selectExpr("city", "timestamp", "seq + 100 AS seq", "aqi + 1 AS aqi")
    base = ST.scratch_path(spark, "stream-test")
    rev.coalesce(1).write.parquet(f"{base}/in")             # revisions land first
    orig.coalesce(1).write.mode("append").parquet(f"{base}/in")
    schema = spark.read.parquet(f"{base}/in").schema
    for ck in ("c1", "c2"):                                  # second run = full replay
        SJ.stream_readings_upsert(spark, f"{base}/in", schema, f"{base}/t", f"{base}/{ck}", max_files_per_trigger=1)
        got = {r.seq: r.aqi for r in spark.read.parquet(f"{base}/t").collect()}
        assert got == {0: 0.0, 1: 1.0, 2: 2.0, 103: 4.0, 104: 5.0}
