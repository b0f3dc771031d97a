"""Model registry as a table.

Metadata rows ``(target, version_num, model_name, version, status,
model_path, confidence, cv_rmse, test_rmse, test_mae, test_r2,
feature_count, data_rows_used, training_duration_seconds, trained_at)`` are
appended to a Parquet table; fitted pipelines are saved with Spark ML's own
writer under ``model_path``.  Version numbers, retention and lookups are
DataFrame operations per target.
"""
from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from airlens import constants as C
from airlens.functions import scalars as S
from airlens.session import materialise
from airlens.sinks.store import read_table, upsert
from airlens.sources.feeds import latest_active_models


def assign_versions(existing: DataFrame | None, new_rows: DataFrame, base_path: str = "models") -> DataFrame:
    """Next version number per target (max + 1, in ``trained_at``
    order for several new rows), version name, artefact path, confidence."""
    w = Window.partitionBy("target").orderBy("trained_at", "model_name")
    seq = F.row_number().over(w)
    if existing is not None:
        top = existing.groupBy("target").agg(F.max("version_num").alias("_max"))
        new_rows = new_rows.join(top, "target", "left")
        vn = F.coalesce(F.col("_max"), F.lit(0)) + seq
    else:
        vn = seq
    out = new_rows.withColumn("version_num", vn.cast("int"))
    out = out.withColumns({
        "version": S.version_name("version_num"),
        "model_path": F.concat(F.lit(base_path.rstrip("/") + "/"), S.artefact_name("target", "version_num")),
        "confidence": S.confidence("target"),
        "status": F.lit("active"),
    })
    return out.drop("_max") if "_max" in out.columns else out


def register(spark: SparkSession, registry_path: str, models_path: str, new_rows: DataFrame,
             artefacts: Mapping[str, PipelineModel] | None = None, keep: int = C.RETAIN_VERSIONS) -> DataFrame:
    """K08 / T05 as a store: append the next versions, save their pipelines,
    mark versions beyond ``keep`` inactive and delete their artefacts.
    Returns the registry.

    Pipelines are saved before their rows appear, and deleted after the rows
    are inactive, so an active row always has its pipeline."""
    existing = read_table(spark, registry_path)
    added = materialise(assign_versions(existing, new_rows, models_path), "versions")
    for r in added.select("target", "model_path").collect():
        if artefacts and r["target"] in artefacts:
            artefacts[r["target"]].write().overwrite().save(r["model_path"])
    every = added if existing is None else existing.unionByName(added, allowMissingColumns=True)
    upsert(apply_retention(every, keep), registry_path, ["target", "version_num"])
    stored = read_table(spark, registry_path)
    fs_conf = spark.sparkContext._jsc.hadoopConfiguration()
    for r in stored.where("status = 'inactive'").select("model_path").collect():
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(r["model_path"])
        path.getFileSystem(fs_conf).delete(path, True)
    return stored


def load_latest(spark: SparkSession, registry_path: str) -> dict[str, PipelineModel]:
    """target -> pipeline of its newest active version, in horizon order; all
    that scoring needs is read from the store."""
    meta = read_table(spark, registry_path)
    if meta is None:
        raise ValueError(f"no model registered in {registry_path}")
    latest = {r["target"]: r["model_path"] for r in latest_active_models(meta, drop=()).select("target", "model_path").collect()}
    return {t: PipelineModel.load(latest[t]) for t in C.TARGETS if t in latest}


def apply_retention(meta: DataFrame, keep: int = C.RETAIN_VERSIONS) -> DataFrame:
    """T05 (Q16): the newest ``keep`` versions per target stay active,
    older ones are marked inactive (their artefacts may be deleted)."""
    w = Window.partitionBy("target").orderBy(F.col("version_num").desc())
    r = F.row_number().over(w)
    return meta.withColumn("status", F.when(r <= keep, F.lit("active")).otherwise(F.lit("inactive")))


def lookup(targets: DataFrame, meta: DataFrame, default_model: str = "unknown") -> DataFrame:
    """Every requested target with its latest active model, defaults
    where none is registered."""
    latest = latest_active_models(meta).select("target", "model_name", "version", "cv_rmse", "test_r2")
    j = targets.select("target").distinct().join(latest, "target", "left")
    return j.select("target", F.coalesce("model_name", F.lit(default_model)).alias("model_name"),
                    F.coalesce("version", F.lit("n/a")).alias("version"), "cv_rmse", "test_r2",
                    S.confidence("target").alias("confidence"))
