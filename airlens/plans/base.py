"""What query modules share: the registry of queries and their SQL twins, and
rounding that both engines do alike."""
from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airlens import constants as C
from airlens.plans import sqlparts as Q

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def sql_round(c, digits: int = 6):
    """round(x * 10^d) / 10^d: the same binary steps SQL engines use for
    ``round(double, d)``, so both sides of a check round identically."""
    p = float(10 ** digits)
    return F.round(F.col(c) * p, 0) / p


def round_cols(df: DataFrame, cols, digits: int = 6) -> DataFrame:
    cols = set(cols)
    return df.select(*[sql_round(c, digits).alias(c) if c in cols else F.col(c) for c in df.columns])


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    dbl = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return round_cols(df, dbl, digits)


FEATURE_OUT = (["city", "date"] + Q.DAILY_NAMES + [n for n, _ in Q.feature_exprs()] + ["fc_pressure_drop_d1"])
DOUBLE_FEATURES = [c for c in FEATURE_OUT if c not in ("city", "date", "dow")]


def features_sql(src_cte: dict, rounded) -> str:
    feat_cols = [n for n, _ in Q.feature_exprs()] + ["fc_pressure_drop_d1"]
    keep = [c for c in C.FEATURE_COLS] + C.TARGETS
    return (Q.ctes(**src_cte, d=Q.daily("r"), f=Q.features("d"))
            + f"SELECT {Q.select_rounded(['city', 'date'] + Q.DAILY_NAMES + feat_cols, rounded)} "
            + f"FROM f WHERE {Q.not_null(sorted(set(keep)))}")
