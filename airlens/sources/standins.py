"""Reading-shaped views derived from the driver's test tables.

The operators are written for air-quality readings; the test tables are a
generic star schema plus an event stream.  These views map columns onto
reading columns with plain projections and aggregations (documented in
FIXTURES.md), so every query's work grows with the tables it reads.

V1  raw readings     events:   city <- event_type, timestamp <- ts, aqi <- value ...
V2  hourly readings  V1 averaged per (city, hour); precipitation = readings in the hour
V2d densified hourly V2 on a complete per-city hour calendar (real gaps appear)
V3  lineitem readings city <- l_returnflag, timestamp <- l_shipdate (midnight) ...
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airlens import constants as C
from airlens.session import cut_lineage

READING_MEASURES = C.MEASURES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1: one reading per event.  ``seq`` (event_id) orders copies.

    Scale factors are chosen so that derived values are non-terminating
    decimals: averages of terminating decimals hit exact rounding ties,
    where two engines' summation orders round differently.  Required
    measures derive from ``value`` (same range at every scale factor);
    ``user_id`` grows with the scale factor and only feeds co and wind
    direction."""
    e = table(spark, sf_dir, "events")
    v = F.col("value")
    u = F.col("user_id").cast("double")
    return e.select(
        F.col("event_type").alias("city"),
        F.col("ts").alias("timestamp"),
        F.col("event_id").alias("seq"),
        (v / 1.09).alias("aqi"),
        (v / 1.31).alias("pm2_5"),
        (v / 0.857).alias("pm10"),
        (u * 10.0 / 3.07).alias("co"),
        (v / 2.2).alias("no2"),
        (v / 6.01).alias("so2"),
        (v / 2.93).alias("o3"),
        (v / 11.3 - 10.0).alias("temperature"),
        (v / 5.71).alias("humidity"),
        (v / 13.7).alias("wind_speed"),
        (u * 360.0 / 151.0).alias("wind_direction"),
        (v / 7.03 + 950.0).alias("pressure"),
        F.lit(1.0).alias("precipitation"),
    )


def to_hourly(readings: DataFrame) -> DataFrame:
    """Readings -> hourly means per city; precipitation is summed."""
    # date_trunc returns a zoned TIMESTAMP; keep the naive (NTZ) type.
    r = readings.withColumn("timestamp", F.date_trunc("hour", "timestamp").cast("timestamp_ntz"))
    aggs = [F.avg(c).alias(c) for c in READING_MEASURES if c != "precipitation"]
    aggs.append(F.sum("precipitation").alias("precipitation"))
    return r.groupBy("city", "timestamp").agg(*aggs)


def hourly_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V2: hourly means per city; precipitation is the number of events."""
    return to_hourly(event_readings(spark, sf_dir))


def hour_calendar(readings: DataFrame, key: str = "city", ts: str = "timestamp") -> DataFrame:
    """Every hour between each key's first and last reading (explode of a
    per-key sequence: no join fan-out, rows grow with the covered span)."""
    span = readings.groupBy(key).agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi"))
    return span.select(key, F.explode(F.sequence("_lo", "_hi", F.expr("INTERVAL 1 HOUR"))).alias(ts))


def densified_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V2d: hourly readings on a complete hour calendar (missing hours NULL).

    The hourly aggregate is the grain-reduction boundary and is consumed by
    several branches downstream (calendar span, the calendar join, the
    gap-fill summary and window, the daily rollup and last-6 mean).  It is
    materialised once (reliable checkpoint in the shared checkpoint folder)
    so raw events are scanned and shuffled exactly once."""
    h = cut_lineage(hourly_readings(spark, sf_dir))
    return hour_calendar(h).join(h, ["city", "timestamp"], "left")


def lineitem_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V3: long daily series (2.5k days per key), several rows per day."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_returnflag").alias("city"),
        F.col("l_shipdate").alias("timestamp"),
        F.col("l_quantity").alias("aqi"),
        (F.col("l_extendedprice") / 1000.0).alias("pm2_5"),
        (F.col("l_extendedprice") / 100.0).alias("pm10"),
        F.col("l_discount").alias("temperature"),
        F.col("l_tax").alias("humidity"),
        F.col("l_linenumber").cast("double").alias("wind_speed"),
        F.col("l_suppkey").cast("double").alias("pressure"),
        (F.col("l_quantity") / 10.0).alias("precipitation"),
    )


def daily_actuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily actual AQI per city from the long series (V3 -> day means)."""
    r = lineitem_readings(spark, sf_dir)
    return r.groupBy("city", F.to_date("timestamp").alias("date")).agg(F.avg("aqi").alias("aqi_mean"))


REVISION_FROM = "2024-01-25"


def redelivered_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second delivery of the readings from ``REVISION_FROM`` on,
    revised (+1 on aqi) and delivered later (larger ``seq``)."""
    r = event_readings(spark, sf_dir)
    return (r.where(F.col("timestamp") >= F.lit(REVISION_FROM).cast("timestamp_ntz"))
             .withColumn("seq", F.col("seq") + F.lit(1_000_000_000))
             .withColumn("aqi", F.col("aqi") + 1.0))


def orders_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second daily feed keyed by day only: mean order price as pressure."""
    o = table(spark, sf_dir, "orders")
    return (o.groupBy(F.col("o_orderdate").alias("timestamp"))
             .agg(F.avg("o_totalprice").alias("pressure"), F.count(F.lit(1)).alias("n_orders")))
