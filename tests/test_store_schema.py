"""Stores keep every column and every row, whatever the batches look like."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from airlens import session
from airlens.sinks import schemas
from airlens.sinks import store as ST


def day(m, d):
    return dt.date(2024, m, d)


def scratch(spark):
    base = f"{session.checkpoint_dir(spark)}/tables-{spark.sparkContext.applicationId}"
    return sorted(os.listdir(base.removeprefix("file:"))) if os.path.isdir(base.removeprefix("file:")) else []


@pytest.fixture(params=["10m", "-1"])
def joins(spark, request):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", request.param)
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_column_that_a_later_batch_lacks_stays(spark, joins, tmp_path):
    p = str(tmp_path / "f")
    ST.save_features(spark.createDataFrame([("a", day(1, 5), 1.0)], "city string, date date, x double"), p)
    ST.save_features(spark.createDataFrame([("a", day(2, 1), 1.5, 2.0)], "city string, date date, x double, y double"), p)
    ST.save_features(spark.createDataFrame([("a", day(2, 2), 3.0)], "city string, date date, x double"), p)
    ST.save_features(spark.createDataFrame([("a", day(2, 1), 9.0)], "city string, date date, z double"), p)
    got = {(r.date, r.x, r.y, r.z) for r in ST.read_table(spark, p).collect()}
    assert got == {(day(1, 5), 1.0, None, None), (day(2, 1), 1.5, 2.0, 9.0), (day(2, 2), 3.0, None, None)}
    files = {r.y for r in spark.read.option("mergeSchema", True).parquet(p).collect()}
    assert files == {None, 2.0}


@pytest.mark.parametrize("parts", [None, ["m"]])
@pytest.mark.parametrize("first", ["wide", "narrow"])
@pytest.mark.parametrize("mode", ["replace", "merge"])
def test_wide_and_narrow_batches_in_either_order(spark, tmp_path, mode, first, parts):
    p, want, columns = str(tmp_path / "t"), {}, {"v"}
    wide = spark.createDataFrame([(1, "a", 10, 1.0), (2, "b", 20, 2.0)], "k int, m string, v int, w double")
    narrow = spark.createDataFrame([(2, "b", 21), (3, "a", 30)], "k int, m string, v int")
    for batch in ([wide, narrow] if first == "wide" else [narrow, wide]) + [narrow]:
        ST.upsert(batch, p, ["k"], parts, mode=mode)
        for r in batch.collect():
            new = {c: r[c] for c in batch.columns if c not in ("k", "m")}
            want[r.k] = (want.get(r.k, {}) if mode == "merge" else {}) | new
    got = {r.k: {c: r[c] for c in ("v", "w")} for r in ST.read_table(spark, p).collect()}
    assert got == {k: {"v": v.get("v"), "w": v.get("w")} for k, v in want.items()}


@pytest.mark.parametrize("parts", [None, ["m"]])
@pytest.mark.parametrize("mode", ["replace", "merge", "latest", "update"])
def test_null_keys_are_keys(spark, joins, tmp_path, mode, parts):
    p = str(tmp_path / "t")
    batch = spark.createDataFrame([(1, None, "a", 1), (None, "x", None, 2), (None, None, "", 3)], "k int, j string, m string, v int")
    ST.upsert(batch.limit(2), p, ["k", "j"], parts)
    for _ in range(3):
        ST.upsert(batch, p, ["k", "j"], parts, mode=mode, order="v")
    got = sorted((tuple(r[c] for c in ("k", "j", "v")) for r in ST.read_table(spark, p).collect()), key=repr)
    want = [(1, None, 1), (None, "x", 2)] + ([] if mode == "update" else [(None, None, 3)])
    assert got == sorted(want, key=repr)
    res = ST.upsert(batch, p, ["k", "j"], parts, count=True)
    assert (res.inserted, res.updated) == ((1, 2) if mode == "update" else (0, 3))


def test_raw_and_current_with_null_keys(spark, tmp_path):
    raw = spark.createDataFrame([(None, dt.datetime(2024, 1, 1, 3), 5.0), ("a", None, 6.0)],
                                "city string, timestamp timestamp_ntz, aqi double")
    for _ in range(3):
        ST.save_raw(raw, str(tmp_path / "r"))
        ST.save_current(raw.limit(1), str(tmp_path / "c"))
    assert ST.read_table(spark, str(tmp_path / "r")).count() == 2
    assert ST.read_table(spark, str(tmp_path / "c")).count() == 1


def test_documents_gain_fields_and_types_widen(spark, tmp_path):
    p = str(tmp_path / "d")
    one = spark.sql("SELECT 'a' city, DATE'2024-01-01' prediction_date, named_struct('aqi', 1.5D) day1, 1 n, 2.5F s")
    two = spark.sql("SELECT 'a' city, DATE'2024-01-02' prediction_date, named_struct('label', 'x', 'aqi', 2.5D) day1, "
                    "5000000000 n, 0.1D s, CAST(NULL AS VOID) gone")
    ST.save_predictions(one, p)
    ST.save_predictions(two, p)
    ST.save_predictions(one, p)
    got = {r.prediction_date.day: (r.day1.asDict(), r.n, r.s) for r in ST.read_table(spark, p).collect()}
    assert got == {1: ({"aqi": 1.5, "label": None}, 1, 2.5), 2: ({"aqi": 2.5, "label": "x"}, 5000000000, 0.1)}
    with pytest.raises(ValueError, match="column n is bigint"):
        ST.save_predictions(spark.sql("SELECT 'a' city, DATE'2024-01-02' prediction_date, 'x' n"), p)
    assert ST.read_table(spark, p).count() == 2


def test_names_that_differ_in_case_are_one_column(spark, tmp_path):
    p = str(tmp_path / "t")
    ST.upsert(spark.createDataFrame([(1, 2.0)], "k int, pm double"), p, ["k"], mode="merge")
    ST.upsert(spark.createDataFrame([(2, 3.0)], "k int, PM double"), p, ["k"], mode="merge")
    t = ST.read_table(spark, p)
    assert sorted(t.columns) == ["k", "pm"] and {(r.k, r.pm) for r in t.collect()} == {(1, 2.0), (2, 3.0)}


def test_a_table_without_a_declaration_and_a_cut_off_one(spark, tmp_path):
    p = str(tmp_path / "t")
    spark.createDataFrame([(1, "a", 1)], "k int, m string, v int").write.partitionBy("m").parquet(p)
    spark.createDataFrame([(2, "b", 2.0)], "k int, m string, w double").write.mode("append").partitionBy("m").parquet(p)
    ST.upsert(spark.createDataFrame([(3, "b")], "k int, m string"), p, ["k"], ["m"])
    want = {(1, "a", 1, None), (2, "b", None, 2.0), (3, "b", None, None)}
    assert {(r.k, r.m, r.v, r.w) for r in ST.read_table(spark, p).collect()} == want
    (tmp_path / "t" / schemas.FOLDER / "00000009.json").write_text('{"type": "str')
    assert {(r.k, r.m, r.v, r.w) for r in ST.read_table(spark, p).collect()} == want


def test_nothing_is_left_in_the_scratch_folder(spark, tmp_path):
    before = scratch(spark)
    good = spark.createDataFrame([(1, 1)], "k int, v int")
    for batch in (good, good, good.union(good), good.limit(0), good.withColumn("v", F.raise_error(F.lit("no")).cast("int"))):
        try:
            ST.upsert(batch, str(tmp_path / "t"), ["k"])
        except Exception:  # noqa: BLE001 - two of them fail
            pass
    assert scratch(spark) == before and ST.read_table(spark, str(tmp_path / "t")).count() == 1


def test_only_touched_partitions_are_rewritten(spark, tmp_path):
    p = str(tmp_path / "t")
    ST.upsert(spark.createDataFrame([(k, f"m{k % 4}", k) for k in range(40)], "k int, m string, v int"), p, ["k"], ["m"])
    files = {d: sorted(os.listdir(f"{p}/{d}")) for d in os.listdir(p) if d.startswith("m=")}
    ST.upsert(spark.createDataFrame([(5, "m1", -5)], "k int, m string, v int"), p, ["k"], ["m"], mode="merge")
    assert {d for d in files if sorted(os.listdir(f"{p}/{d}")) != files[d]} == {"m=m1"}
    assert ST.read_table(spark, p).count() == 40
