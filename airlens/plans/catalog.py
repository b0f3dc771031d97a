"""Registered queries: every operator bound to the driver's test tables.

Each entry pairs a Spark query (spark, sf_dir) -> DataFrame with an
independent DuckDB statement over the same parquet views (or None when the
operator is not SQL-expressible, e.g. model fitting).  Names follow the
SURVEY ids.  Importing this module imports all query modules, which register
themselves with :mod:`airlens.plans.base`.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from airlens import constants as C
from airlens.operators import clean as CL
from airlens.operators import features as FE
from airlens.plans import q_eval, q_explain, q_flows, q_ml, q_model, q_profile, q_sources, q_store, q_time  # noqa: F401 - they register themselves
from airlens.plans import sqlparts as Q
from airlens.plans.base import DOUBLE_FEATURES, ORACLES, QUERIES, features_sql, register, round_cols, round_doubles  # noqa: F401
from airlens.session import cut_lineage
from airlens.sources import standins as V


# --------------------------------------------------------------------------
# C01 on the long daily series (lineitem)
# --------------------------------------------------------------------------
@register("c01_features_lineitem", features_sql({"r": Q.V3}, Q.ROUND6))
def c01_features_lineitem(spark, sf_dir):
    r = V.lineitem_readings(spark, sf_dir)
    return round_cols(FE.compute_features(r, "city", "timestamp"), Q.ROUND6)


# --------------------------------------------------------------------------
# Flagship: events -> hourly -> densify -> clean -> daily features
# --------------------------------------------------------------------------
def _clean_sql_ctes() -> dict:
    p, g = Q.gap_fill("rng", Q.MEASURES)
    return {"v1": Q.V1, "v2": Q.V2, "v2d": Q.V2D, "rng": Q.range_null("v2d", Q.MEASURES),
            "rng_p": p, "g": g,
            "cl": f"SELECT * FROM g WHERE {Q.not_null(C.REQUIRED_COLUMNS)}"}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    hourly = V.densified_hourly(spark, sf_dir)
    # Cleaned hourly rows feed two branches (day aggregates, last-6 mean):
    # materialise them once instead of recomputing the gap-fill plan.
    cleaned = cut_lineage(CL.clean_readings(hourly, "city", "timestamp"))
    return round_doubles(FE.compute_features(cleaned, "city", "timestamp"))


register("c01_features_events_clean",
         features_sql({**_clean_sql_ctes(), "r": "SELECT * FROM cl"}, set(DOUBLE_FEATURES)))(flagship)
