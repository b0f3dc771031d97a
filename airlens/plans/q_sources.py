"""Source, hygiene, rollup and store queries (V1/V2/V2c/V3 views)."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from airlens import constants as C
from airlens.operators import clean as CL
from airlens.operators import features as FE
from airlens.operators import rollup as RU
from airlens.plans import q_eval as QE
from airlens.plans import sqlparts as Q
from airlens.plans.base import register, round_cols, round_doubles
from airlens.sinks import store as ST
from airlens.sources import feeds as SRC
from airlens.sources import standins as V

M = Q.MEASURES
V1_COLS = ["city", "timestamp", "seq"] + M
REV = ("SELECT city, \"timestamp\", seq + 1000000000 AS seq, aqi + 1.0 AS aqi, "
       + ", ".join(m for m in M if m != "aqi") + " FROM v1 WHERE \"timestamp\" >= TIMESTAMP '2024-01-25'")
_q = lambda cols: ", ".join(f'"{c}"' if c == "timestamp" else c for c in cols)


# P03 / P04 / U02 / K04 ------------------------------------------------------------
@register("p03_dedupe_keep_first", Q.ctes(v1=Q.V1, rev=REV, u=f"SELECT {_q(V1_COLS)} FROM v1 UNION ALL SELECT {_q(V1_COLS)} FROM rev")
          + f"SELECT {_q(V1_COLS)} FROM (SELECT *, row_number() OVER (PARTITION BY city, \"timestamp\" ORDER BY seq) AS rn FROM u) WHERE rn = 1")
def p03_dedupe_keep_first(spark, sf_dir):
    u = V.event_readings(spark, sf_dir).unionByName(V.redelivered_readings(spark, sf_dir))
    return CL.dedupe(u, ["city", "timestamp"], ["seq"], keep="first")


@register("p04_u02_merge_keep_last", Q.ctes(v1=Q.V1, rev=REV, u=f"SELECT {_q(V1_COLS)}, 0 AS src FROM v1 UNION ALL SELECT {_q(V1_COLS)}, 1 FROM rev")
          + f"SELECT {_q(V1_COLS)} FROM (SELECT *, row_number() OVER (PARTITION BY city, \"timestamp\" ORDER BY src DESC, seq DESC) AS rn FROM u) WHERE rn = 1")
def p04_merge_keep_last(spark, sf_dir):
    return CL.keep_latest_version(V.event_readings(spark, sf_dir), V.redelivered_readings(spark, sf_dir),
                                  ["city", "timestamp"], ["seq"])


@register("k04_unique_check", Q.ctes(v1=Q.V1, rev=REV, u=f"SELECT {_q(V1_COLS)} FROM v1 UNION ALL SELECT {_q(V1_COLS)} FROM rev")
          + "SELECT city, \"timestamp\", count(*) AS n FROM u GROUP BY ALL HAVING count(*) > 1")
def k04_unique_check(spark, sf_dir):
    u = V.event_readings(spark, sf_dir).unionByName(V.redelivered_readings(spark, sf_dir))
    return ST.check_unique(u, ["city", "timestamp"])


# P05 / P06 / P07 -------------------------------------------------------------
V3_COLS = ["city", "timestamp", "aqi", "pm2_5", "pm10", "temperature", "humidity", "wind_speed", "pressure", "precipitation"]
V3_RANGED = Q.range_null("v3", V3_COLS[2:])


@register("p05_range_null", Q.ctes(v3=Q.V3) + V3_RANGED)
def p05_range_null(spark, sf_dir):
    return CL.null_out_of_range(V.lineitem_readings(spark, sf_dir))


@register("p06_out_of_range_counts", Q.ctes(v3=Q.V3) + " UNION ALL ".join(
    f"SELECT city, '{c}' AS \"column\", CAST(count_if({c} < {C.VALID_RANGES[c][0]} OR {c} > {C.VALID_RANGES[c][1]}) AS BIGINT) AS n_out_of_range FROM v3 GROUP BY city"
    for c in V3_COLS[2:]))
def p06_out_of_range_counts(spark, sf_dir):
    return CL.out_of_range_counts(V.lineitem_readings(spark, sf_dir), by="city")


@register("p07_drop_required_nulls", Q.ctes(v3=Q.V3, rg=V3_RANGED)
          + "SELECT * FROM rg WHERE aqi IS NOT NULL AND temperature IS NOT NULL AND humidity IS NOT NULL AND pm10 IS NOT NULL AND pm2_5 IS NOT NULL")
def p07_drop_required_nulls(spark, sf_dir):
    return CL.drop_required_nulls(CL.null_out_of_range(V.lineitem_readings(spark, sf_dir)))


# W12-W14 / P20 / P10 ---------------------------------------------------------
_GP, _G = Q.gap_fill("v2d", M)
_FILL_SQL = (Q.ctes(v1=Q.V1, v2=Q.V2, v2d=Q.V2D, v2d_p=_GP, g=_G)
             + f"SELECT city, \"timestamp\", {Q.select_rounded(M, set(M))} FROM g")


@register("w12_w14_gap_fill", _FILL_SQL)
def w12_w14_gap_fill(spark, sf_dir):
    d = V.densified_hourly(spark, sf_dir)
    return round_cols(CL.fill_gaps(d, "city", "timestamp", M, limit=3, bucket="month"), M)


@register("w12_gap_fill_day_buckets", _FILL_SQL)
def w12_gap_fill_day_buckets(spark, sf_dir):
    """Same result with one-day buckets: exercises carry-in across buckets."""
    d = V.densified_hourly(spark, sf_dir)
    return round_cols(CL.fill_gaps(d, "city", "timestamp", M, limit=3, bucket="day"), M)


@register("p20_fill_nulls_all_numeric", _FILL_SQL)
def p20_fill_nulls(spark, sf_dir):
    return round_cols(CL.fill_nulls(V.densified_hourly(spark, sf_dir)), M)


_ANGLE = '"timestamp", wind_direction AS d'
_WIND = (Q.ctes(v1=Q.V1, v2=Q.V2, v2d=Q.V2D,
                p=f"SELECT city, {_ANGLE}, row_number() OVER (PARTITION BY city ORDER BY \"timestamp\") AS rn FROM v2d",
                n="SELECT *, last_value(d IGNORE NULLS) OVER b AS pv, last_value(CASE WHEN d IS NOT NULL THEN rn END IGNORE NULLS) OVER b AS pr, "
                  "first_value(d IGNORE NULLS) OVER f AS nv, first_value(CASE WHEN d IS NOT NULL THEN rn END IGNORE NULLS) OVER f AS nr FROM p "
                  "WINDOW b AS (PARTITION BY city ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
                  "f AS (PARTITION BY city ORDER BY rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)",
                t="SELECT *, CAST(least(rn - pr, 3) AS DOUBLE) / nullif(nr - pr, 0) AS t FROM n",
                xy="SELECT *, (1 - t) * cos(radians(pv)) + t * cos(radians(nv)) AS x, (1 - t) * sin(radians(pv)) + t * sin(radians(nv)) AS y FROM t",
                a="SELECT *, round(degrees(atan2(y, x)) * 1e9, 0) / 1e9 AS a FROM xy")
         + 'SELECT city, "timestamp", round(CASE WHEN d IS NOT NULL THEN d WHEN pv IS NULL THEN nv WHEN nv IS NULL THEN pv '
           "WHEN x * x + y * y < 1e-18 THEN pv ELSE a - 360 * floor(a / 360) END, 6) AS wind_direction FROM a")


@register("p20_circular_wind", _WIND)
def p20_circular_wind(spark, sf_dir):
    """Q13: wind directions are interpolated along the circle."""
    d = V.densified_hourly(spark, sf_dir).select("city", "timestamp", "wind_direction")
    return round_cols(CL.fill_nulls(d, circular=["wind_direction"]), ["wind_direction"])


def _clean_ctes():
    p, g = Q.gap_fill("rng", M)
    return dict(v1=Q.V1, v2=Q.V2, v2d=Q.V2D, rng=Q.range_null("v2d", M), rng_p=p, g=g)


@register("p10_clean_readings", Q.ctes(**_clean_ctes())
          + f"SELECT city, \"timestamp\", {Q.select_rounded(M, set(M))} FROM g WHERE {Q.not_null(C.REQUIRED_COLUMNS)}")
def p10_clean_readings(spark, sf_dir):
    return round_cols(CL.clean_readings(V.densified_hourly(spark, sf_dir)), M)


@register("p11_validate_hourly", Q.ctes(v1=Q.V1, v2=Q.V2)
          + "SELECT city, count(*) AS n_rows, count(*) >= 24 AS ok FROM v2 GROUP BY city")
def p11_validate_hourly(spark, sf_dir):
    return FE.validate_hourly(V.hourly_readings(spark, sf_dir))


# A01-A05 ---------------------------------------------------------------------
@register("a01_a04_daily_rollup_events", Q.ctes(v1=Q.V1, d=Q.daily("v1"))
          + f"SELECT city, date, {Q.select_rounded(Q.DAILY_NAMES, set(Q.DAILY_NAMES))} FROM d")
def a01_daily_rollup(spark, sf_dir):
    return round_doubles(RU.daily_rollup(V.event_readings(spark, sf_dir)))


@register("a02_last6_mean", Q.ctes(v1=Q.V1)
          + "SELECT city, date, round(avg(aqi), 6) AS aqi_last6h FROM (SELECT city, CAST(\"timestamp\" AS DATE) AS date, aqi, "
            "row_number() OVER (PARTITION BY city, CAST(\"timestamp\" AS DATE) ORDER BY \"timestamp\" DESC, aqi DESC) AS rn FROM v1) "
            "WHERE rn <= 6 GROUP BY city, date")
def a02_last6_mean(spark, sf_dir):
    r = V.event_readings(spark, sf_dir).withColumn("date", F.to_date("timestamp"))
    return round_cols(RU.last_n_mean(r, "city", "timestamp", "aqi", 6), ["aqi_last6h"])


@register("a05_forecast_daily", Q.ctes(v1=Q.V1, v2=Q.V2)
          + "SELECT city, CAST(\"timestamp\" AS DATE) AS date, round(avg(temperature), 6) AS temp_mean, "
            "round(avg(humidity), 6) AS humidity_mean, round(avg(wind_speed), 6) AS wind_mean, "
            "round(avg(pressure), 6) AS pressure_mean, round(coalesce(sum(precipitation), 0.0), 6) AS precip_sum FROM v2 GROUP BY ALL")
def a05_forecast_daily(spark, sf_dir):
    return round_doubles(RU.forecast_daily(V.hourly_readings(spark, sf_dir)))


# S01 -------------------------------------------------------------------------
@register("s01_payload_explode", Q.ctes(v1=Q.V1, v2=Q.V2, v2d=Q.V2D)
          + "SELECT city, \"timestamp\", aqi, pm2_5 FROM v2d")
def s01_payload_explode(spark, sf_dir):
    """Densified hours packed into one payload per (city, day) -- parallel
    arrays, exclusive end -- then shaped back into rows."""
    d = V.densified_hourly(spark, sf_dir)
    pk = (d.groupBy("city", F.to_date("timestamp").alias("day"))
           .agg(F.array_sort(F.collect_list(F.struct("timestamp", "aqi", "pm2_5"))).alias("pts"))
           .select("city", F.col("pts")[0]["timestamp"].alias("start"),
                   (F.element_at("pts", -1)["timestamp"] + F.expr("INTERVAL 1 HOUR")).alias("end"),
                   F.lit(3600).alias("interval_s"),
                   F.struct(F.transform("pts", lambda p: p["aqi"]).alias("aqi"),
                            F.transform("pts", lambda p: p["pm2_5"]).alias("pm2_5")).alias("variables")))
    return SRC.explode_series_payload(pk, ["aqi", "pm2_5"])


# S02 / S03 / S07 / P01 / P02 -------------------------------------------------
# Provider variable -> reading column of each feed.
_AQ, _WX = dict(zip(C.AQ_VARIABLES, C.AQ_COLUMNS)), dict(zip(C.WEATHER_VARIABLES, C.WEATHER_COLUMNS))


@register("s02_s03_s07_landing_ingest", Q.ctes(v1=Q.V1, v2=Q.V2)
          + "SELECT city, \"timestamp\", " + ", ".join(_AQ.values()) + ", " + ", ".join(_WX.values())
          + ", TIMESTAMP '2024-02-01 00:00:00' AS ingested_at, 'landing' AS source FROM v2")
def s02_s03_s07_landing_ingest(spark, sf_dir):
    """Provider-named AQ and weather feeds are landed as Parquet, read back
    with explicit schemas, renamed (P01), joined on (city, timestamp) and
    stamped (P02)."""
    h = V.hourly_readings(spark, sf_dir)
    base = ST.scratch_path(spark, "landing")
    h.select("city", "timestamp", *[F.col(v).alias(k) for k, v in _AQ.items()]).write.parquet(f"{base}/aq")
    h.select("city", "timestamp", *[F.col(v).alias(k) for k, v in _WX.items()]).write.parquet(f"{base}/wx")
    out = SRC.raw_ingest(SRC.read_air_quality(spark, f"{base}/aq"), SRC.read_weather(spark, f"{base}/wx"), "2024-02-01 00:00:00", "landing")
    return out.select("city", "timestamp", *_AQ.values(), *_WX.values(), "ingested_at", "source")


# J01 -------------------------------------------------------------------------
@register("j01_feeds_join", Q.ctes(v3=Q.V3, d=Q.daily("v3"))
          + "SELECT d.city, d.date, round(d.aqi_mean, 6) AS aqi_mean, round(o.pressure, 6) AS order_pressure, o.n_orders "
            "FROM d JOIN (SELECT CAST(o_orderdate AS DATE) AS date, avg(o_totalprice) AS pressure, count(*) AS n_orders "
            "FROM orders GROUP BY 1) o ON d.date = o.date")
def j01_feeds_join(spark, sf_dir):
    d = RU.daily_rollup(V.lineitem_readings(spark, sf_dir), last_n=None)
    o = V.orders_by_day(spark, sf_dir).select(F.to_date("timestamp").alias("date"),
                                             F.col("pressure").alias("order_pressure"), "n_orders")
    return round_cols(d.join(o, "date", "inner").select("city", "date", "aqi_mean", "order_pressure", "n_orders"),
                      ["aqi_mean", "order_pressure"])


# U01 -------------------------------------------------------------------------
@register("u01_union_feeds", Q.ctes(v1=Q.V1, v3=Q.V3)
          + "SELECT city, \"timestamp\", aqi, seq FROM v1 UNION ALL SELECT city, \"timestamp\", aqi, NULL FROM v3")
def u01_union_feeds(spark, sf_dir):
    a = V.event_readings(spark, sf_dir).select("city", "timestamp", "aqi", "seq")
    b = V.lineitem_readings(spark, sf_dir).select("city", "timestamp", "aqi")
    return a.unionByName(b, allowMissingColumns=True)


# S05 / S06 / S08 / S09 -------------------------------------------------------
@register("s05_daily_window", Q.ctes(v1=Q.V1)
          + "SELECT * FROM v1 WHERE CAST(\"timestamp\" AS DATE) BETWEEN DATE '2024-01-17' AND DATE '2024-01-19'")
def s05_daily_window(spark, sf_dir):
    return SRC.in_window(V.event_readings(spark, sf_dir), "2024-01-20", mode="daily")


@register("s05_backfill_window", Q.ctes(v3=Q.V3)
          + "SELECT * FROM v3 WHERE CAST(\"timestamp\" AS DATE) BETWEEN DATE '2000-01-01' - 730 AND DATE '2000-01-01' - 1")
def s05_backfill_window(spark, sf_dir):
    return SRC.in_window(V.lineitem_readings(spark, sf_dir), "2000-01-01", mode="backfill")


@register("s06_chunk_coverage", Q.ctes(v3=Q.V3)
          + "SELECT k.city, c.chunk_id, c.chunk_start, c.chunk_end, coalesce(n.n_rows, 0) AS n_rows, coalesce(n.n_rows, 0) = 0 AS missing "
            "FROM (SELECT DISTINCT city FROM v3) k, "
            "(SELECT CAST(datediff('day', DATE '1995-01-01', s) / 30 AS INTEGER) AS chunk_id, CAST(s AS DATE) AS chunk_start, "
            "least(CAST(s AS DATE) + 29, DATE '2001-12-31') AS chunk_end "
            "FROM unnest(generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 30 DAY)) t(s)) c "
            "LEFT JOIN (SELECT city, CAST(floor(datediff('day', DATE '1995-01-01', CAST(\"timestamp\" AS DATE)) / 30) AS INTEGER) AS chunk_id, count(*) AS n_rows "
            "FROM v3 WHERE CAST(\"timestamp\" AS DATE) BETWEEN DATE '1995-01-01' AND DATE '2001-12-31' GROUP BY ALL) n "
            "ON n.city = k.city AND n.chunk_id = c.chunk_id")
def s06_chunk_coverage(spark, sf_dir):
    return SRC.chunk_coverage(V.lineitem_readings(spark, sf_dir), "1995-01-01", "2001-12-31")


_CHUNK = "CAST(floor(datediff('day', DATE '2024-01-01', CAST(\"timestamp\" AS DATE)) / 7) AS INTEGER)"


@register("s06_chunk_account", Q.ctes(v1=Q.V1, v2=Q.V2)
          + "SELECT CAST(c.i AS INTEGER) AS chunk_id, DATE '2024-01-01' + CAST(7 * c.i AS INTEGER) AS chunk_start, "
            "least(DATE '2024-01-01' + CAST(7 * c.i + 6 AS INTEGER), DATE '2024-01-30') AS chunk_end, "
            "CASE WHEN c.i <> 2 THEN coalesce(n.n, 0) END AS n_rows, c.i = 2 AS failed FROM range(5) c(i) "
            f"LEFT JOIN (SELECT {_CHUNK} AS i, count(*) AS n FROM v2 GROUP BY 1) n ON n.i = c.i")
def s06_chunk_account(spark, sf_dir):
    """A feed landed week by week, one week missing: the others load in one
    read, and the account names the one that did not."""
    base, cols = _land_weeks(spark, sf_dir, "week <> 2", "parquet")
    _, account = SRC.load_chunk_files(spark, "2024-01-01", "2024-01-30", base, SRC.AQ_SCHEMA, _week_of("file"), "parquet", 7)
    return account.select("chunk_id", "chunk_start", "chunk_end", "n_rows", F.col("error").isNotNull().alias("failed"))


def _week_of(file: str):
    return F.regexp_extract(file, "week=([0-9]+)", 1).cast("int")


def _land_weeks(spark, sf_dir, which: str, fmt: str):
    h = V.hourly_readings(spark, sf_dir)
    base = ST.scratch_path(spark, "chunks")
    week = F.floor(F.datediff(F.to_date("timestamp"), F.lit("2024-01-01").cast("date")) / 7).cast("int")
    cols = ["city", "timestamp", *[F.col(v).alias(k) for k, v in _AQ.items()]]
    h.select(*cols, week.alias("week")).where(which).write.partitionBy("week").format(fmt).save(base)
    return base, cols


@register("s06_file_account", Q.ctes(v1=Q.V1, v2=Q.V2)
          + f"SELECT {_CHUNK} AS week, count(*) AS n_rows, CAST(CASE WHEN {_CHUNK} = 1 THEN 2 ELSE 0 END AS BIGINT) AS n_bad, "
            f"{_CHUNK} = 1 AS has_error FROM v2 GROUP BY ALL "
            "UNION ALL SELECT 9, NULL, 0, true")
def s06_file_account(spark, sf_dir):
    """JSON files by week; two records of week 1 are cut off and one file is no
    JSON archive at all.  Every other row loads, and the account has the
    file of each failure."""
    base, _ = _land_weeks(spark, sf_dir, "true", "json")
    spark.createDataFrame([('{"city": "a", "pm10": 1.',), ("not json",)], "value string").coalesce(1).write.mode("append").text(f"{base}/week=1")
    spark.createDataFrame([("no archive",)], "value string").coalesce(1).write.text(f"{base}/plain")
    _rename_as_archive(spark, f"{base}/plain", f"{base}/week=9")
    rows, account = SRC.load_files(spark, base, SRC.AQ_SCHEMA, "json")
    per = account.groupBy(_week_of("file").alias("week")).agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_bad").alias("n_bad"), F.max(F.col("error").isNotNull()).alias("has_error"))
    loaded = rows.groupBy(_week_of(SRC.FILE).alias("week")).agg(F.count(F.lit(1)).alias("loaded"))
    same = per.join(loaded, "week", "left")
    return same.select("week", F.when(F.col("n_rows").eqNullSafe(F.col("loaded")), F.col("n_rows")).alias("n_rows"), "n_bad", "has_error")


def _rename_as_archive(spark, folder: str, to: str) -> None:
    """The files of ``folder`` below ``to``, named like compressed JSON, which they are not."""
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(sc._jsc.hadoopConfiguration())
    fs.mkdirs(path(to))
    for k, f in enumerate(s.getPath() for s in fs.listStatus(path(folder)) if s.getPath().getName().startswith("part-")):
        fs.rename(f, path(f"{to}/broken-{k}.json.gz"))
    fs.delete(path(folder), True)


@register("s08_x03_latest_reading", Q.ctes(v1=Q.V1)
          + "SELECT city, arg_max(aqi, (\"timestamp\", aqi)) AS aqi, max(\"timestamp\") AS \"timestamp\" FROM v1 WHERE aqi IS NOT NULL GROUP BY city")
def s08_latest_reading(spark, sf_dir):
    return SRC.latest_reading(V.event_readings(spark, sf_dir))


@register("s09_recent_raw", Q.ctes(v1=Q.V1, v2=Q.V2)
          + f"SELECT city, \"timestamp\", {Q.select_rounded(M, set(M))} FROM v2 WHERE \"timestamp\" >= TIMESTAMP '2024-01-25 00:00:00' - INTERVAL 7 DAY")
def s09_recent_raw(spark, sf_dir):
    # The cutoff is hour-aligned, so filtering raw stamps before the hourly
    # rollup gives the same rows and lets the predicate reach the scan.
    raw = SRC.recent(V.event_readings(spark, sf_dir), "2024-01-25 00:00:00", 7)
    return round_cols(V.to_hourly(raw), M)


# S16 / K07 -------------------------------------------------------------------
@register("s16_k07_csv_roundtrip",
          "SELECT n.n_nationkey, n.n_name, r.r_name, TIMESTAMP '2024-01-01 00:00:00' + to_days(n.n_nationkey) AS created_at "
          "FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey")
def s16_csv_roundtrip(spark, sf_dir):
    """Export (K07) a joined reference table to header CSV and read it back
    with an explicit schema and timestamp format (S16)."""
    n = V.table(spark, sf_dir, "nation")
    r = V.table(spark, sf_dir, "region")
    df = n.join(r, n.n_regionkey == r.r_regionkey).select(
        "n_nationkey", "n_name", "r_name",
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.col("n_nationkey"))).alias("created_at"))
    path = ST.scratch_path(spark, "csv")
    ST.export_csv(df, path)
    schema = T.StructType([T.StructField("n_nationkey", T.IntegerType()), T.StructField("n_name", T.StringType()),
                           T.StructField("r_name", T.StringType()), T.StructField("created_at", T.TimestampNTZType())])
    return SRC.read_csv(spark, path, schema)


@register("s16_k07_csv_documents", Q.ctes(v3=Q.V3, act=QE.ACT, preds=QE.PREDS)
          + "SELECT city, prediction_date, p1 AS day1_aqi, " + QE.label_sql("p1") + " AS day1_label, "
            "p2 AS day2_aqi, " + QE.label_sql("p2") + " AS day2_label FROM preds")
def s16_csv_documents(spark, sf_dir):
    """Nested prediction documents, flattened, exported and read back."""
    docs = QE._base(spark, sf_dir)[1].select("city", "prediction_date", "day1", "day2")
    path = ST.scratch_path(spark, "csv")
    ST.export_csv(docs, path)
    days = [T.StructField(f"day{h}_{n}", t) for h in (1, 2) for n, t in (("aqi", T.DoubleType()), ("label", T.StringType()))]
    return SRC.read_csv(spark, path, T.StructType([T.StructField("city", T.StringType()),
                                                   T.StructField("prediction_date", T.DateType()), *days]))


# K09 -------------------------------------------------------------------------
@register("k09_feature_count", Q.ctes(v3=Q.V3, d=Q.daily("v3")) + "SELECT count(*) AS n_rows FROM d")
def k09_feature_count(spark, sf_dir):
    return ST.row_count(RU.daily_rollup(V.lineitem_readings(spark, sf_dir)))


# S04 -------------------------------------------------------------------------
@register("s04_a05_forecast_feed", Q.ctes(v1=Q.V1, v2=Q.V2)
          + "SELECT city, CAST(\"timestamp\" AS DATE) AS date, round(avg(temperature), 6) AS temp_mean, "
            "round(avg(humidity), 6) AS humidity_mean, round(avg(wind_speed), 6) AS wind_mean, "
            "round(avg(pressure), 6) AS pressure_mean, round(coalesce(sum(precipitation), 0.0), 6) AS precip_sum FROM v2 GROUP BY ALL")
def s04_forecast_feed(spark, sf_dir):
    """A forecast feed (provider names + issue date) landed as Parquet, read
    with its schema and renamed (S04), then rolled up to days (A05)."""
    h = V.hourly_readings(spark, sf_dir)
    path = ST.scratch_path(spark, "forecast")
    (h.select("city", "timestamp", *[F.col(v).alias(k) for k, v in _WX.items()],
              F.to_date("timestamp").alias("issued_date")).write.parquet(path))
    fc = SRC.read_forecast_weather(spark, path)
    return round_doubles(RU.forecast_daily(fc))
