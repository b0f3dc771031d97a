"""End-to-end flows (C02-C06) composed from the operators.

Each flow is a few declarative DataFrame plans with keyed Parquet stores
between them; the stores are the lineage cuts (a written table in shared
storage), so a lost executor never forces recomputation from raw input.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airlens import constants as C
from airlens.operators import clean as CL
from airlens.operators import features as FE
from airlens.operators.rollup import daily_rollup
from airlens.session import materialise
from airlens.sinks import store as ST
from airlens.sources import feeds as SRC


def backfill(spark: SparkSession, aq: DataFrame, weather: DataFrame, raw_path: str, features_path: str,
             ingested_at: str, key: str = "city") -> DataFrame:
    """Ingest (S07) -> clean (P10) -> store raw (K02) -> features with
    targets (C01) from the stored raw table -> store features (K03)."""
    raw = SRC.raw_ingest(aq, weather, ingested_at, key=key)
    cleaned = CL.clean_readings(raw, key, "timestamp")
    ST.save_raw(cleaned, raw_path, key)
    stored = _read_or_empty(spark, raw_path, cleaned.withColumn("day", F.to_date("timestamp"))).drop("day")
    feats = FE.compute_features(stored, key, "timestamp", compute_targets=True)
    ST.save_features(feats, features_path, key, mode="merge")
    return _read_or_empty(spark, features_path, feats.withColumn("month", F.lit(""))).drop("month")


def _read_or_empty(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """A store that received only empty batches has no files yet: read it
    as an empty frame with the expected schema."""
    t = ST.read_table(spark, path)
    return t if t is not None else spark.createDataFrame([], like.schema)


def daily_increment(spark: SparkSession, fresh_raw: DataFrame, raw_path: str, features_path: str, as_of: str,
                    forecast: DataFrame | None = None, lookback_days: int = 14, key: str = "city") -> DataFrame:
    """Clean the fresh window (S05) -> upsert raw -> read back the
    lookback (S09, pruned by the day partition) -> features without targets
    and with the forecast override on each key's last row, which is the live
    row -> merge into the feature store (targets kept, Q02) -> back-fill the
    targets that became known on rows whose features are stored."""
    fresh = SRC.in_window(fresh_raw, as_of, "timestamp", mode="daily")
    ST.save_raw(CL.clean_readings(fresh, key, "timestamp"), raw_path, key)
    ref = F.lit(as_of).cast("date")
    stored = _read_or_empty(spark, raw_path, fresh.withColumn("day", F.to_date("timestamp")))
    hist = stored.where(F.col("day") >= F.date_sub(ref, lookback_days)).drop("day")
    live = FE.compute_features(hist, key, "timestamp", compute_targets=False, forecast=forecast)
    ST.save_features(live, features_path, key, mode="merge")
    daily = FE.add_daily_features(daily_rollup(hist, key), key, targets=True)
    known = daily.select(key, "date", *C.TARGETS).dropna(subset=C.TARGETS)
    ST.save_features(known, features_path, key, mode="update")
    return _read_or_empty(spark, features_path, live.withColumn("month", F.lit(""))).drop("month")


def current_reading(spark: SparkSession, readings: DataFrame, current_path: str, key: str = "city") -> DataFrame:
    """Newest non-null reading per key merged into the current table."""
    cur = SRC.latest_reading(readings, key).withColumn("updated_at", F.col("timestamp"))
    ST.save_current(cur, current_path, key)
    return ST.read_table(spark, current_path)


def training_run(spark: SparkSession, features: DataFrame, registry_path: str, models_path: str, trained_at,
                 feature_cols=tuple(C.FEATURE_COLS), grids=C.MODEL_GRIDS, key: str = "city", **kw) -> list:
    """Rows with all targets (S10) -> chained competitions (M08, M09) ->
    pipelines saved (M11) and registered with their metadata (K08, T05)."""
    from airlens.modeling import models as MD
    from airlens.modeling import registry as RG
    rows = SRC.training_rows(features, required=True)
    chain, _ = MD.train_chain(rows, feature_cols, grids, key, **kw)
    RG.register(spark, registry_path, models_path, MD.metadata_frame(spark, chain, trained_at),
                {t.target: t.model for t in chain})
    return chain


def prediction_run(spark: SparkSession, features: DataFrame, registry_path: str, predictions_path: str,
                   predicted_at, key: str = "city", **kw) -> tuple[DataFrame, DataFrame]:
    """Latest row per key -> pipelines of the latest active versions, read
    from the store -> chained, clamped scores -> prediction documents keyed
    (key, prediction_date = latest date + 1) (K06) -> day-1 attributions
    against the last 30 days (M15).  Returns (stored documents, attributions)."""
    from airlens.modeling import models as MD
    from airlens.modeling import registry as RG
    chain = RG.load_latest(spark, registry_path)
    latest = materialise(SRC.latest_row(features, key, "date"), "latest")
    scored = MD.score_chain(latest, chain, key)
    docs = scored.select(key, F.date_add("date", 1).alias("prediction_date"),
                         F.lit(predicted_at).cast("timestamp_ntz").alias("predicted_at"),
                         *[c for c in ("day1", "day2", "day3") if c in scored.columns])
    ST.save_predictions(docs, predictions_path, key)
    first = next(iter(chain.values()))
    names = MD.model_features(first)
    ground = MD.recent_background(features, latest.agg(F.max("date")).first()[0])
    phi, kind = MD.explain(first, latest, ground, names, (key, "date"), **kw)
    return (ST.read_table(spark, predictions_path).drop("month"), phi.withColumn("method", F.lit(kind)))
