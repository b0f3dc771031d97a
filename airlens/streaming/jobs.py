"""Structured Streaming forms of the incremental jobs.

The reference re-reads the last days and upserts by key, so re-runs are
safe and revised readings win.  The streaming equivalents:

X01  file stream -> foreachBatch: keep the latest ``seq`` per key within the
     batch, then an order-independent keyed upsert (a stored row is only
     replaced by a row with a larger ``seq``), written with dynamic
     partition overwrite.  Replaying a batch changes nothing.
X02  tumbling one-day windows with a 3-day watermark (the reference's
     re-read span), update mode, each batch upserted by (key, window); or
     touched days computed anew from the stored readings, for aggregates that
     have no running form (the last six readings of a day) and for late rows.
X03  latest reading per key (``max_by``), update mode, upserted by key.

All runs use ``trigger(availableNow=True)``: process what has landed, then
stop -- the batch-scheduled cadence of the reference, with exactly-once
bookkeeping in the checkpoint folder.
"""
from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from airlens.operators.rollup import daily_rollup
from airlens.session import materialise, transient
from airlens.sinks.store import read_table, upsert


class _Progress(StreamingQueryListener):
    """Adds up the rows that fell behind the watermark, batch by batch; a
    query's own record of its progress keeps the last batches only."""

    def __init__(self):
        self.late, self.ended = 0, threading.Event()
        self.run_id = None
        self.held = []

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        self.held.append((str(event.progress.runId), sum(op.numRowsDroppedByWatermark for op in event.progress.stateOperators)))

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        if str(event.runId) == self.run_id:
            self.ended.set()

    def total(self, run_id: str) -> int:
        return sum(n for r, n in self.held if r == run_id)


def _run(frame: DataFrame, checkpoint: str, batch, mode: str = "append") -> int:
    """Process what has landed, then stop.  Returns the number of rows that
    came later than the watermark and were left out, over all batches."""
    streams, seen = frame.sparkSession.streams, _Progress()
    streams.addListener(seen)
    try:
        q = (frame.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
             .foreachBatch(lambda df, number: batch(df, number)).trigger(availableNow=True).start())
        seen.run_id = str(q.runId)
        q.awaitTermination()
        seen.ended.wait(30)  # events arrive in order, the end after all progress
        return seen.total(seen.run_id)
    finally:
        streams.removeListener(seen)


def stream_readings_upsert(spark: SparkSession, landing: str, schema: T.StructType, target: str,
                           checkpoint: str, keys=("city", "timestamp"), order: str = "seq",
                           max_files_per_trigger: int | None = None) -> None:
    """Land -> upsert, revised readings win, idempotent."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    src = r.parquet(landing).withColumn("day", F.to_date("timestamp"))
    _run(src, checkpoint, lambda b, _: upsert(b, target, list(keys), ["day"], mode="latest", order=order))


def stream_daily_rollup(spark: SparkSession, landing: str, schema: T.StructType, target: str,
                        checkpoint: str, key: str = "city", ts: str = "timestamp",
                        watermark: str = "3 days") -> int:
    """One-day tumbling windows, watermark, update mode -> upsert.
    The table is partitioned by month, so a batch rewrites the months it
    touches.  Returns the number of rows too late for the watermark."""
    # Event-time watermarks need TIMESTAMP (with zone); the session is
    # pinned to UTC, so casting naive UTC stamps is lossless.
    src = spark.readStream.schema(schema).parquet(landing).withColumn(ts, F.col(ts).cast("timestamp"))
    agg = (src.withWatermark(ts, watermark)
              .groupBy(F.col(key), F.window(ts, "1 day").alias("w"))
              .agg(F.count(F.lit(1)).alias("n_rows"), F.avg("aqi").alias("aqi_mean"),
                   F.max("aqi").alias("aqi_max"), F.min("aqi").alias("aqi_min"),
                   F.sum("precipitation").alias("precip_sum"))
              .select(key, F.to_date(F.col("w.start")).alias("date"), "n_rows", "aqi_mean", "aqi_max",
                      "aqi_min", "precip_sum"))
    return _run(agg, checkpoint, lambda b, _: upsert(with_month(b), target, [key, "date"], ["month"]), "update")


def with_month(days: DataFrame) -> DataFrame:
    return days.withColumn("month", F.date_format("date", "yyyy-MM"))


def stream_touched_days(spark: SparkSession, landing: str, schema: T.StructType, base: str, checkpoint: str,
                        key: str = "city", ts: str = "timestamp", order: str = "seq", late_days: int = 3,
                        max_files_per_trigger: int | None = None) -> int:
    """X02 with all of A01-A04 and nothing left out: each batch is upserted into
    the readings, and the days it has rows for are computed anew from them.

    Tables below ``base``: ``readings`` (by day), ``daily`` (by month), ``late``
    (the rows more than ``late_days`` days older than the newest reading of the
    batches before, by batch) and ``batches`` (rows, late rows and newest time of
    each).  A batch that is run again gives the same tables.  The work follows
    the days that a batch touches; a late row costs its day.  Rows without a
    time belong to no day and stay in the readings.  Returns the late rows of
    this run."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    src, late = r.parquet(landing).withColumn("day", F.to_date(ts)), []

    def batch(df: DataFrame, number: int) -> None:
        with transient(spark):
            rows = materialise(df, "landed")
            upsert(rows, f"{base}/readings", [key, ts], ["day"], mode="latest", order=order)
            seen = read_table(spark, f"{base}/batches")
            newest = seen.where(F.col("batch") < number).agg(F.max("newest")).first()[0] if seen is not None else None
            behind = (rows.where(F.col(ts) < F.lit(newest).cast("timestamp_ntz") - F.make_dt_interval(F.lit(late_days)))
                      if newest is not None else rows.limit(0))
            (behind.withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("batch").parquet(f"{base}/late"))
            days = rows.select(key, "day").where("day is not null").distinct()
            stored = read_table(spark, f"{base}/readings")
            # The plain join on the day lets Spark leave other days' files out.
            same_key = F.col(f"r.{key}").eqNullSafe(F.col(f"d.{key}")) & (F.col("r.day") == F.col("d.day"))
            touched = stored.alias("r").join(days.alias("d"), same_key, "left_semi")
            upsert(with_month(daily_rollup(touched, key, ts)), f"{base}/daily", [key, "date"], ["month"])
            facts = rows.agg(F.lit(number).cast("long").alias("batch"), F.count(F.lit(1)).alias("n_rows"),
                             F.max(F.col(ts).cast("timestamp_ntz")).alias("newest")).withColumn("n_late", F.lit(behind.count()).cast("long"))
            late.append(facts.first()["n_late"])
            upsert(facts, f"{base}/batches", ["batch"], buckets=1)
    _run(src, checkpoint, batch)
    return sum(late)


def stream_latest_reading(spark: SparkSession, landing: str, schema: T.StructType, target: str,
                          checkpoint: str, key: str = "city", ts: str = "timestamp", value: str = "aqi") -> None:
    """Newest non-null reading per key, update mode -> upsert by key."""
    src = spark.readStream.schema(schema).parquet(landing).where(F.col(value).isNotNull())
    pick = F.max_by(F.struct(F.col(value).alias(value), F.col(ts).alias(ts)), F.struct(F.col(ts), F.col(value)))
    agg = src.groupBy(key).agg(pick.alias("_r")).select(key, f"_r.{value}", f"_r.{ts}")
    _run(agg, checkpoint, lambda b, _: upsert(b, target, [key]), "update")
