"""Sources (S01-S17): landed feeds, shaping, range plans and keyed reads.

The reference pulls from a web API; here every feed is a landed file read
with an explicit schema (no inference), and every "now" is an ``as_of``
parameter so reads are reproducible and prune on date-partitioned tables.
"""
from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airlens import constants as C
from airlens.operators.clean import _as_list, dedupe
from airlens.session import materialise

D = T.DoubleType()
AQ_SCHEMA = T.StructType([T.StructField("city", T.StringType()),
                          T.StructField("timestamp", T.TimestampNTZType())]
                         + [T.StructField(v, D) for v in C.AQ_VARIABLES])
WEATHER_SCHEMA = T.StructType([T.StructField("city", T.StringType()),
                               T.StructField("timestamp", T.TimestampNTZType())]
                              + [T.StructField(v, D) for v in C.WEATHER_VARIABLES])



def _read(spark: SparkSession, path: str, schema: T.StructType, fmt: str) -> DataFrame:
    """Landed files; a missing or unreadable one is an error, never a silent gap."""
    r = spark.read.schema(schema)
    return r.option("mode", "FAILFAST").json(path) if fmt == "json" else r.format(fmt).load(path)


# S01 -------------------------------------------------------------------------
def explode_series_payload(payload: DataFrame, variables, key="city") -> DataFrame:
    """One row per time step from (key, start, end, interval_s, variables
    struct of parallel arrays); ``end`` is exclusive.  Each payload row
    expands inside its own task (``inline``), no shuffle."""
    keys = _as_list(key)
    step = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("interval_s"))
    stamps = F.sequence(F.col("start"), F.col("end") - step, step)
    zipped = F.arrays_zip(stamps.alias("timestamp"),
                          *[F.col(f"variables.{v}").alias(v) for v in variables])
    return payload.select(*keys, F.inline(zipped))


# S02 / S03 / S04 -------------------------------------------------------------
def read_air_quality(spark, path: str, fmt: str = "parquet") -> DataFrame:
    return rename_provider_columns(_read(spark, path, AQ_SCHEMA, fmt))


def read_weather(spark, path: str, fmt: str = "parquet") -> DataFrame:
    return rename_provider_columns(_read(spark, path, WEATHER_SCHEMA, fmt))


def read_forecast_weather(spark, path: str, fmt: str = "parquet") -> DataFrame:
    # A new StructType: StructType.add would mutate the shared schema.
    schema = T.StructType(WEATHER_SCHEMA.fields + [T.StructField("issued_date", T.DateType())])
    return rename_provider_columns(_read(spark, path, schema, fmt))


def rename_provider_columns(df: DataFrame, mapping: dict | None = None) -> DataFrame:
    """Rename by map; names not present are ignored."""
    return df.withColumnsRenamed(C.COLUMN_RENAME_MAP if mapping is None else mapping)


def add_constants(df: DataFrame, constants: dict) -> DataFrame:
    """Constant columns (city, source, ingested_at ...)."""
    return df.withColumns({k: F.lit(v) for k, v in constants.items()})  # lit() leaves a Column as it is


# S05 -------------------------------------------------------------------------
def date_window(as_of, mode: str = "daily", backfill_days: int = 730, daily_days: int = 3):
    """(start, end) Columns: backfill ``[as_of-730, as_of-1]``, daily ``[as_of-3, as_of-1]``."""
    ref = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    n = backfill_days if mode == "backfill" else daily_days
    return F.date_sub(ref, n), F.date_sub(ref, 1)


def in_window(df: DataFrame, as_of, ts: str = "timestamp", mode: str = "daily", **kw) -> DataFrame:
    start, end = date_window(as_of, mode, **kw)
    d = F.to_date(F.col(ts))
    return df.where(d.between(start, end))


# S06 -------------------------------------------------------------------------
def chunk_plan(frame: DataFrame, start, end, chunk_days: int = 30) -> DataFrame:
    """The rows of ``frame`` once per ``chunk_days`` chunk of [start, end]:
    chunk_id, chunk_start, chunk_end."""
    s = F.lit(start).cast("date") if isinstance(start, str) else start
    e = F.lit(end).cast("date") if isinstance(end, str) else end
    base = frame.select("*", F.explode(F.sequence(s, e, F.expr(f"INTERVAL {chunk_days} DAYS"))).alias("chunk_start"))
    return base.select(
        *frame.columns, ((F.datediff("chunk_start", s) / chunk_days).cast("int")).alias("chunk_id"),
        "chunk_start", F.least(F.date_add("chunk_start", chunk_days - 1), e).alias("chunk_end"))


def _why(e: Exception) -> str:
    """The first line of an error, or its kind where it has no text."""
    text = str(e).strip()
    return text.splitlines()[0][:500] if text else type(e).__name__


def _in_threads(run, items, parallelism: int) -> list:
    """run(item) for each item, ``parallelism`` jobs at a time, in the caller's context."""
    with ThreadPoolExecutor(max(1, min(parallelism, len(items)))) as pool:
        return [f.result() for f in [pool.submit(copy_context().run, run, x) for x in items]]


def load_chunks(spark: SparkSession, start: str, end: str, load, chunk_days: int = 30,
                parallelism: int = 8) -> tuple[DataFrame, DataFrame]:
    """Load [start, end] chunk by chunk with ``load(chunk_start, chunk_end)``,
    which returns a frame or raises; for loads that are calls, not files.

    Returns the rows that loaded and an account with one row per chunk: n_rows,
    or the error of a chunk that failed.  When no chunk loads it is an error.
    A chunk is written to the shared folder as it loads, so a file that breaks
    later breaks its own chunk.  The number of chunks is that of the plan."""
    plan = chunk_plan(spark.range(1), start, end, chunk_days).orderBy("chunk_id").collect()

    def one(c):
        try:
            rows = materialise(load(c["chunk_start"], c["chunk_end"]), "chunk")
            return rows, (c["chunk_id"], c["chunk_start"], c["chunk_end"], rows.count(), None)
        except Exception as e:  # noqa: BLE001 - every failure goes into the account
            return None, (c["chunk_id"], c["chunk_start"], c["chunk_end"], None, _why(e))
    done = _in_threads(one, plan, parallelism)
    got, account = [r for r, _ in done if r is not None], [a for _, a in done]
    if not got:
        raise RuntimeError(f"none of the {len(plan)} chunks loaded: {account[0][-1]}")
    return (reduce(DataFrame.unionByName, got),
            spark.createDataFrame(account, "chunk_id int, chunk_start date, chunk_end date, n_rows long, error string"))


#: The file a landed row came from, and a record that could not be read.
FILE, BAD = "_file", "_corrupt_record"


def load_files(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json",
               parallelism: int = 8) -> tuple[DataFrame, DataFrame]:
    """The rows of all files below ``path`` (with the file of each, ``_file``)
    and an account with one row per file: file, n_bytes, n_rows, n_bad, error.

    All files are read in one distributed job.  Records of a text format that
    cannot be read are counted in ``n_bad``, and the first is quoted.  Only when
    a file breaks that job, the files are divided until the broken ones are
    alone: these have an error and no rows, not even those before the break.
    Files of no bytes are not listed.  No file at all, or none that can be read,
    is an error."""
    text = fmt in ("json", "csv")
    full = T.StructType(schema.fields + [T.StructField(BAD, T.StringType())]) if text else schema

    def read(paths) -> DataFrame:
        r = spark.read.schema(full).format(fmt)
        if text:
            r = r.options(mode="PERMISSIVE", columnNameOfCorruptRecord=BAD, **({"header": "true"} if fmt == "csv" else {}))
        df = r.load(path) if paths is None else r.option("basePath", path).load(paths)
        df = df.select("*", F.col("_metadata.file_path").alias(FILE))
        return df if text else df.withColumn(BAD, F.lit(None).cast("string"))

    def isolate(paths: list[str]) -> tuple[list, list]:
        try:
            return [materialise(read(paths), "landed")], []
        except Exception as e:  # noqa: BLE001 - every failure goes into the account
            if len(paths) == 1:
                return [], [(paths[0], _why(e))]
        size = -(-len(paths) // 8)
        parts = _in_threads(isolate, [paths[i:i + size] for i in range(0, len(paths), size)], parallelism)
        return [x for got, _ in parts for x in got], [x for _, bad in parts for x in bad]

    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
             .select("path", F.col("length").alias("n_bytes"), F.col("_metadata.file_path").alias("file")))
    try:
        got, failed = [materialise(read(None), "landed")], []
    except Exception as e:  # noqa: BLE001 - one of the files, or all
        names = [r[0] for r in files.select("path").collect()]
        if not names:
            raise
        got, failed = isolate(names)
        if not got:
            raise RuntimeError(f"none of the {len(names)} files below {path} can be read: {_why(e)}") from e
    rows = reduce(DataFrame.unionByName, got)
    good = F.col(BAD).isNull()
    counts = rows.groupBy(F.col(FILE).alias("file")).agg(
        F.count_if(good).alias("n"), F.count_if(~good).alias("bad"), F.min(BAD).alias("sample"))
    broken = spark.createDataFrame(failed, "path string, why string")
    account = files.join(counts, "file", "left").join(broken, "path", "left").select(
        "file", "n_bytes", F.when(F.col("why").isNull(), F.coalesce("n", F.lit(0))).alias("n_rows"),
        F.coalesce("bad", F.lit(0)).alias("n_bad"),
        F.coalesce("why", F.when(F.col("bad") > 0, F.concat(F.col("bad").cast("string"), F.lit(" unreadable records, e.g. "),
                                                            F.substring("sample", 1, 200)))).alias("error"))
    return rows.where(good).drop(BAD), account


def load_chunk_files(spark: SparkSession, start: str, end: str, path: str, schema: T.StructType, chunk,
                     fmt: str = "json", chunk_days: int = 30) -> tuple[DataFrame, DataFrame]:
    """:func:`load_files` with an account by planned chunk: chunk_id,
    chunk_start, chunk_end, n_files, n_rows, n_bad, error.  ``chunk`` is the
    chunk_id as a column over ``file``; a chunk without a file has an error."""
    rows, files = load_files(spark, path, schema, fmt)
    found = files.withColumn("chunk_id", chunk).groupBy("chunk_id").agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("n_rows").alias("n_rows"), F.sum("n_bad").alias("n_bad"), F.min("error").alias("error"))
    plan = chunk_plan(spark.range(1), start, end, chunk_days).drop("id")
    return rows, plan.join(found, "chunk_id", "left").select(
        *plan.columns, F.coalesce("n_files", F.lit(0)).alias("n_files"), "n_rows", F.coalesce("n_bad", F.lit(0)).alias("n_bad"),
        F.when(F.col("n_files").isNull(), "no file has landed").otherwise(F.col("error")).alias("error"))


def chunk_coverage(readings: DataFrame, start, end, ts: str = "timestamp", key="city",
                   chunk_days: int = 30) -> DataFrame:
    """Rows per (key, chunk) for every planned chunk; missing chunks give 0.
    The chunk id is computed per row (no range join): an equi-aggregation."""
    keys = _as_list(key)
    s = F.lit(start).cast("date") if isinstance(start, str) else start
    e = F.lit(end).cast("date") if isinstance(end, str) else end
    d = F.to_date(F.col(ts))
    counts = (readings.where(d.between(s, e))
              .withColumn("chunk_id", (F.datediff(d, s) / chunk_days).cast("int"))
              .groupBy(*keys, "chunk_id").agg(F.count(F.lit(1)).alias("n_rows")))
    # Every key gets the planned chunks in place, so no join fans out.
    grid = chunk_plan(readings.select(*keys).distinct(), s, e, chunk_days)
    return (grid.join(counts, keys + ["chunk_id"], "left")
            .withColumn("n_rows", F.coalesce("n_rows", F.lit(0)).cast("long"))
            .withColumn("missing", F.col("n_rows") == 0))


# S07 -------------------------------------------------------------------------
def raw_ingest(aq: DataFrame, weather: DataFrame, ingested_at, source: str = "landing",
               key="city", ts: str = "timestamp") -> DataFrame:
    """AQ joined to weather on (key, timestamp), provider names renamed,
    ingest metadata added.  Both feeds are hash-partitioned on the join key;
    AQE turns the join into a broadcast when one side is small."""
    keys = _as_list(key)
    j = rename_provider_columns(aq).join(rename_provider_columns(weather), keys + [ts], "inner")
    return add_constants(j, {"ingested_at": F.lit(ingested_at).cast("timestamp_ntz"), "source": source})


# S08 / X03 -------------------------------------------------------------------
def latest_reading(readings: DataFrame, key="city", ts: str = "timestamp", value: str = "aqi") -> DataFrame:
    """Latest non-null ``value`` per key (``max_by``: partial aggregation)."""
    keys = _as_list(key)
    r = readings.where(F.col(value).isNotNull())
    pick = F.max_by(F.struct(F.col(value).alias(value), F.col(ts).alias(ts)), F.struct(F.col(ts), F.col(value)))
    return r.groupBy(*keys).agg(pick.alias("_r")).select(*keys, f"_r.{value}", f"_r.{ts}")


# S09 / S12 / S13 -------------------------------------------------------------
def recent(df: DataFrame, as_of, days: int, ts: str = "timestamp") -> DataFrame:
    """Rows with ``ts >= as_of - days`` (pushed to the scan)."""
    ref = F.lit(as_of).cast("timestamp_ntz") if isinstance(as_of, str) else as_of
    return df.where(F.col(ts) >= ref - F.make_dt_interval(F.lit(days)))


# S10 -------------------------------------------------------------------------
def training_rows(features: DataFrame, required: bool = False) -> DataFrame:
    """Rows with all targets; with ``required``, none at all is an error."""
    present = [t for t in C.TARGETS if t in features.columns]
    rows = features.where(F.lit(True) if not present else
                          F.expr(" AND ".join(f"{t} IS NOT NULL" for t in present)))
    if required and rows.isEmpty():
        raise ValueError("the training set is empty")
    return rows


# S11 / S17 -------------------------------------------------------------------
def latest_row(df: DataFrame, key="city", order: str = "date") -> DataFrame:
    """Newest row per key, as the largest struct that begins with ``order``: a
    partial aggregate, so one key with a third of the rows is reduced
    map-side rather than sorted in one task."""
    return dedupe(df, key, order, keep="last")


def latest_active_models(meta: DataFrame, drop=("model_path",)) -> DataFrame:
    """Newest active version per target, storage ids removed."""
    act = meta.where(F.col("status") == "active")
    return latest_row(act, "target", "version_num").drop(*[c for c in drop if c in meta.columns])


# S14 / S15 -------------------------------------------------------------------
def actuals(features: DataFrame, key="city") -> DataFrame:
    keys = _as_list(key)
    return features.select(*keys, "date", "aqi_mean").where(F.col("aqi_mean").isNotNull())


def current_for(keys_df: DataFrame, current: DataFrame, key="city") -> DataFrame:
    """Left join: every requested key with its current reading, or NULLs."""
    keys = _as_list(key)
    return keys_df.select(*keys).distinct().join(current, keys, "left")


# S16 -------------------------------------------------------------------------
def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             timestamp_format: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    return (spark.read.schema(schema).option("header", True)
            .option("timestampFormat", timestamp_format).option("dateFormat", "yyyy-MM-dd")
            .csv(path))


# J08 -------------------------------------------------------------------------
def current_or_daily(latest_daily: DataFrame, current: DataFrame, key="city") -> DataFrame:
    """Current reading with its own time when one exists, else the latest
    daily mean with its date, else 0.  ``latest_daily``: (key, date, aqi_mean)
    one row per key; ``current``: (key, aqi, timestamp) one row per key, looked
    up by key (S15)."""
    keys = _as_list(key)
    c = current_for(latest_daily, current, key).select(*keys, F.col("aqi").alias("_cur"), F.col("timestamp").alias("_at"))
    j = latest_daily.join(c, keys, "left")
    live = F.col("_cur").isNotNull()
    return j.select(*keys, F.col("date").alias("latest_date"),
                    F.when(live, F.coalesce("_at", F.col("date").cast("timestamp_ntz")))
                     .otherwise(F.col("date").cast("timestamp_ntz")).alias("current_at"),
                    F.coalesce("_cur", "aqi_mean", F.lit(0.0)).alias("current_aqi"),
                    F.when(live, "current").when(F.col("aqi_mean").isNotNull(), "daily").otherwise("none").alias("source"))
