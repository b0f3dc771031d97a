"""Keyed-store and streaming queries: write, upsert, read back, compare."""
from __future__ import annotations

from pyspark.sql import functions as F

from airlens.plans import sqlparts as Q
from airlens.plans.base import ORACLES, register, round_cols
from airlens.plans.q_sources import REV, V1_COLS, _q
from airlens.sinks import store as ST
from airlens.sources import standins as V
from airlens.streaming import jobs as SJ

CUT = "2001-09-01"
DAILY = ('SELECT city, CAST("timestamp" AS DATE) AS date, avg(aqi) AS aqi_mean, count(*) AS n_obs FROM v3 GROUP BY ALL')
BATCH = (f"SELECT city, date, aqi_mean + 1.0 AS aqi_mean FROM base WHERE date >= DATE '{CUT}' "
         f"UNION ALL SELECT 'Z', date, aqi_mean FROM base WHERE city = 'A' AND date >= DATE '{CUT}'")


def _base_and_batch(spark, sf_dir):
    base = (V.lineitem_readings(spark, sf_dir).groupBy("city", F.to_date("timestamp").alias("date"))
            .agg(F.avg("aqi").alias("aqi_mean"), F.count(F.lit(1)).alias("n_obs")))
    recent = base.where(F.col("date") >= F.lit(CUT).cast("date"))
    batch = (recent.select("city", "date", (F.col("aqi_mean") + 1.0).alias("aqi_mean"))
             .unionByName(recent.where(F.col("city") == "A").select(F.lit("Z").alias("city"), "date", "aqi_mean")))
    return base, batch


def _upsert_query(spark, sf_dir, mode, by_month=True):
    """History, then the batch in two parts, then its second part again."""
    base, batch = _base_and_batch(spark, sf_dir)
    p = ST.scratch_path(spark, f"k01-{mode}")
    month = F.date_format("date", "yyyy-MM")
    zed = F.col("city") == "Z"
    for part in (base, batch.where(~zed), batch.where(zed), batch.where(zed)):
        if by_month:
            ST.upsert(part.withColumn("month", month), p, ["city", "date"], ["month"], mode=mode)
        else:
            ST.upsert(part, p, ["city", "date"], mode=mode)
    return round_cols(ST.read_table(spark, p).select("city", "date", "aqi_mean", "n_obs"), ["aqi_mean"])


@register("k01_upsert_replace", Q.ctes(v3=Q.V3, base=DAILY, batch=BATCH)
          + "SELECT city, date, round(aqi_mean, 6) AS aqi_mean, n_obs FROM (SELECT b.* FROM base b ANTI JOIN batch n USING (city, date) "
            "UNION ALL SELECT city, date, aqi_mean, NULL FROM batch)")
def k01_upsert_replace(spark, sf_dir):
    return _upsert_query(spark, sf_dir, "replace")


_REPLACED = ORACLES["k01_upsert_replace"]


@register("k01_upsert_replace_unpartitioned", _REPLACED)
def k01_upsert_replace_unpartitioned(spark, sf_dir):
    """The same batches into a store without partition columns of its own."""
    return _upsert_query(spark, sf_dir, "replace", by_month=False)


@register("k05_upsert_merge", Q.ctes(v3=Q.V3, base=DAILY, batch=BATCH)
          + "SELECT coalesce(n.city, b.city) AS city, coalesce(n.date, b.date) AS date, "
            "round(CASE WHEN n.city IS NOT NULL THEN n.aqi_mean ELSE b.aqi_mean END, 6) AS aqi_mean, b.n_obs "
            "FROM base b FULL OUTER JOIN batch n ON b.city = n.city AND b.date = n.date")
def k05_upsert_merge(spark, sf_dir):
    return _upsert_query(spark, sf_dir, "merge")


WIDE = (f"SELECT city, date, aqi_mean + 1.0 AS aqi_mean, n_obs * 2.5 AS extra FROM base WHERE date >= DATE '{CUT}' "
        f"UNION ALL SELECT NULL, date, aqi_mean, 7.0 FROM base WHERE city = 'A' AND date >= DATE '{CUT}'")
NARROW = f"SELECT city, date, n_obs + 1 AS n_obs FROM base WHERE date >= DATE '{CUT}' + 20"
_SAME = "n.city IS NOT DISTINCT FROM b.city AND n.date = b.date"


def _widened(spark, sf_dir, mode):
    """History; a batch with a column more, one less and keys without a city;
    a batch that lacks the new column and another one.  Each one three times."""
    base, _ = _base_and_batch(spark, sf_dir)
    recent = base.where(F.col("date") >= F.lit(CUT).cast("date"))
    wide = (recent.select("city", "date", (F.col("aqi_mean") + 1.0).alias("aqi_mean"), (F.col("n_obs") * 2.5).alias("extra"))
            .unionByName(recent.where("city = 'A'").select(F.lit(None).cast("string").alias("city"), "date", "aqi_mean",
                                                           F.lit(7.0).alias("extra"))))
    narrow = (base.where(F.col("date") >= F.date_add(F.lit(CUT).cast("date"), 20))
              .select("city", "date", (F.col("n_obs") + 1).alias("n_obs")))
    p, month = ST.scratch_path(spark, f"wide-{mode}"), F.date_format("date", "yyyy-MM")
    for part in (base, wide, wide, wide, narrow, narrow, narrow):
        ST.upsert(part.withColumn("month", month), p, ["city", "date"], ["month"], mode=mode)
    return round_cols(ST.read_table(spark, p).select("city", "date", "aqi_mean", "n_obs", "extra"), ["aqi_mean", "extra"])


@register("k01_replace_widened", Q.ctes(v3=Q.V3, base=DAILY, wide=WIDE, narrow=NARROW,
          s="SELECT city, date, aqi_mean, CAST(NULL AS BIGINT) AS n_obs, extra FROM wide UNION ALL "
            f"SELECT b.city, b.date, b.aqi_mean, b.n_obs, NULL FROM base b WHERE NOT EXISTS (SELECT 1 FROM wide n WHERE {_SAME})")
          + "SELECT city, date, round(aqi_mean, 6) AS aqi_mean, n_obs, round(extra, 6) AS extra FROM ("
            "SELECT city, date, CAST(NULL AS DOUBLE) AS aqi_mean, n_obs, CAST(NULL AS DOUBLE) AS extra FROM narrow UNION ALL "
            f"SELECT b.* FROM s b WHERE NOT EXISTS (SELECT 1 FROM narrow n WHERE {_SAME}))")
def k01_replace_widened(spark, sf_dir):
    return _widened(spark, sf_dir, "replace")


@register("k05_merge_widened", Q.ctes(v3=Q.V3, base=DAILY, wide=WIDE, narrow=NARROW,
          s="SELECT coalesce(n.city, b.city) AS city, coalesce(n.date, b.date) AS date, coalesce(n.aqi_mean, b.aqi_mean) AS aqi_mean, "
            f"b.n_obs, n.extra FROM base b FULL OUTER JOIN wide n ON {_SAME}")
          + "SELECT b.city, b.date, round(b.aqi_mean, 6) AS aqi_mean, coalesce(n.n_obs, b.n_obs) AS n_obs, round(b.extra, 6) AS extra "
            f"FROM s b LEFT JOIN narrow n ON {_SAME}")
def k05_merge_widened(spark, sf_dir):
    return _widened(spark, sf_dir, "merge")


@register("k03_save_features_keeps_targets", Q.ctes(v3=Q.V3, d=Q.daily("v3"), f=Q.features("d"))
          + f"SELECT city, date, round(CASE WHEN date >= DATE '{CUT}' THEN aqi_mean + 0.5 ELSE aqi_mean END, 6) AS aqi_mean, "
            "aqi_day1 FROM f")
def k03_save_features(spark, sf_dir):
    """Q02: a live batch without targets is merged into the feature store;
    stored targets survive (replace would erase them)."""
    from airlens.plans.q_profile import features_full
    f = features_full(spark, sf_dir, ["city", "date", "aqi_mean", "aqi_day1"])
    p = ST.scratch_path(spark, "features")
    ST.save_features(f, p)
    ST.save_features(f.select("city", "date", "aqi_day1"), p, mode="update")
    live = f.where(F.col("date") >= F.lit(CUT).cast("date")).select("city", "date", (F.col("aqi_mean") + 0.5).alias("aqi_mean"))
    ST.save_features(live, p, mode="merge")
    return round_cols(ST.read_table(spark, p).drop("month"), ["aqi_mean"])


_P04 = (Q.ctes(v1=Q.V1, rev=REV, u=f"SELECT {_q(V1_COLS)}, 0 AS src FROM v1 UNION ALL SELECT {_q(V1_COLS)}, 1 FROM rev")
        + 'SELECT city, "timestamp", seq, round(aqi, 6) AS aqi FROM (SELECT *, row_number() OVER (PARTITION BY city, "timestamp" ORDER BY seq DESC) AS rn FROM u) WHERE rn = 1')


@register("k02_save_raw", _P04)
def k02_save_raw(spark, sf_dir):
    """Hourly store keyed (city, timestamp), partitioned by day: history,
    then the re-delivered batch replaces the rows it carries.  Of readings of
    one city and moment in a batch the last delivered one is stored."""
    cols = ["city", "timestamp", "seq", "aqi"]
    p = ST.scratch_path(spark, "raw")
    ST.save_raw(V.event_readings(spark, sf_dir).select(*cols), p, order="seq")
    ST.save_raw(V.redelivered_readings(spark, sf_dir).select(*cols), p, order="seq")
    return round_cols(ST.read_table(spark, p).drop("day"), ["aqi"])


HALF = "timestamp_ntz '2024-01-12 00:00:00'"
LANDED = ["city", "timestamp", "seq", "aqi", "precipitation"]


def _land_and_run(spark, rows, job):
    """Land the readings before HALF, run the job, land the others, run it
    again: the second run meets the table that the first one wrote."""
    base = ST.scratch_path(spark, "landing")
    late = 0
    for part in (f"timestamp < {HALF}", f"timestamp >= {HALF}"):
        rows.select(*LANDED).where(part).write.mode("append").parquet(f"{base}/in")
        late += job(f"{base}/in", rows.select(*LANDED).schema, f"{base}/table", f"{base}/ckpt") or 0
    return ST.read_table(spark, f"{base}/table"), late


@register("x01_stream_upsert", _P04)
def x01_stream_upsert(spark, sf_dir):
    """Readings land as files and are upserted, then their revisions land and
    are upserted by a second run; a third run finds nothing new."""
    base = ST.scratch_path(spark, "landing")
    for rows in (V.event_readings(spark, sf_dir), V.redelivered_readings(spark, sf_dir), None):
        if rows is not None:
            rows = rows.select(*LANDED)
            rows.write.mode("append").parquet(f"{base}/in")
            schema = rows.schema
        SJ.stream_readings_upsert(spark, f"{base}/in", schema, f"{base}/table", f"{base}/ckpt")
    return round_cols(ST.read_table(spark, f"{base}/table").select("city", "timestamp", "seq", "aqi"), ["aqi"])


@register("x02_stream_daily_windows", Q.ctes(v1=Q.V1)
          + 'SELECT city, CAST("timestamp" AS DATE) AS date, count(*) AS n_rows, round(avg(aqi), 6) AS aqi_mean, '
            'round(max(aqi), 6) AS aqi_max, round(min(aqi), 6) AS aqi_min, round(sum(precipitation), 6) AS precip_sum FROM v1 GROUP BY ALL')
def x02_stream_daily_windows(spark, sf_dir):
    table, late = _land_and_run(spark, V.event_readings(spark, sf_dir), lambda *at: SJ.stream_daily_rollup(spark, *at))
    if late:
        raise AssertionError(f"{late} readings came too late for the watermark")
    return round_cols(table.drop("month"), ["aqi_mean", "aqi_max", "aqi_min", "precip_sum"])


_FIRST = """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY city, "timestamp" ORDER BY seq DESC) AS rn FROM v1) WHERE rn = 1"""
_HELD_BACK = "city = 'click' AND day(timestamp) IN (3, 5)"


@register("x02_stream_touched_days", Q.ctes(v1=Q.V1, r=_FIRST, d=Q.daily("r"),
                                            late="SELECT count(*) AS n_late FROM v1 WHERE city = 'click' AND day(\"timestamp\") IN (3, 5)")
          + f"SELECT city, date, {Q.select_rounded(Q.DAILY_NAMES, set(Q.DAILY_NAMES))}, n_late FROM d, late")
def x02_stream_touched_days(spark, sf_dir):
    """All daily aggregates, the last six readings included, over three runs;
    the last one brings rows of two days that are weeks behind.  The
    table equals the batch result, and the late rows are all stored."""
    rows, base = V.event_readings(spark, sf_dir), ST.scratch_path(spark, "touched")
    late = 0
    for part in (f"timestamp < {HALF} AND NOT ({_HELD_BACK})", f"timestamp >= {HALF}", f"timestamp < {HALF} AND {_HELD_BACK}"):
        rows.where(part).write.mode("append").parquet(f"{base}/in")
        late += SJ.stream_touched_days(spark, f"{base}/in", rows.schema, base, f"{base}/ckpt")
    stored = spark.read.parquet(f"{base}/late").count()
    if stored != late:
        raise AssertionError(f"{late} late rows counted, {stored} stored")
    out = ST.read_table(spark, f"{base}/daily").select("city", "date", *Q.DAILY_NAMES, F.lit(late).cast("long").alias("n_late"))
    return round_cols(out, Q.DAILY_NAMES)


@register("x03_c04_stream_latest", Q.ctes(v1=Q.V1)
          + 'SELECT city, round(arg_max(aqi, ("timestamp", aqi)), 6) AS aqi, max("timestamp") AS "timestamp" FROM v1 WHERE aqi IS NOT NULL GROUP BY city')
def x03_stream_latest(spark, sf_dir):
    table, _ = _land_and_run(spark, V.event_readings(spark, sf_dir), lambda *at: SJ.stream_latest_reading(spark, *at))
    return round_cols(table, ["aqi"])
