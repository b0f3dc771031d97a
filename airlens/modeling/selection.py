"""Time-ordered splits, expanding-window folds and candidate scoring
(W18, W19, M02, A21).

Positions come from ``row_number`` per key over time, so every split and
fold is computed per key in parallel; there is no global (single-task)
ordering.  A row is tagged with its fold roles by expanding a fixed
3-element array in place -- no join against a fold table.
"""
from __future__ import annotations

from typing import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airlens import constants as C
from airlens.operators.clean import _as_list


def positions(df: DataFrame, key="city", order: str = "date") -> DataFrame:
    keys = _as_list(key)
    w = Window.partitionBy(*keys).orderBy(order)
    return df.select("*", F.row_number().over(w).alias("rn"),
                     F.count(F.lit(1)).over(Window.partitionBy(*keys)).alias("n"))


def time_split(df: DataFrame, key="city", order: str = "date", test_ratio: float = C.TEST_RATIO) -> DataFrame:
    """The first ``floor(n * (1 - r))`` rows of each key train."""
    p = positions(df, key, order)
    return p.withColumn("is_train", F.col("rn") <= F.floor(F.col("n") * (1 - test_ratio)))


def expanding_folds(df: DataFrame, key="city", order: str = "date", n_splits: int = C.CV_SPLITS,
                    positioned: bool = False) -> DataFrame:
    """``test = n // (splits + 1)``; fold k tests the k-th of the last
    ``splits`` blocks and trains on every earlier row.  Output has one row
    per (input row, fold it takes part in) with ``role`` train/test."""
    p = df if positioned else positions(df, key, order)
    ts = F.floor(F.col("n") / (n_splits + 1))
    roles = []
    for k in range(1, n_splits + 1):
        start = F.col("n") - (n_splits - k + 1) * ts          # rows <= start train
        role = (F.when(F.col("rn") <= start, F.lit("train"))
                 .when(F.col("rn") <= start + ts, F.lit("test")))
        roles.append(F.struct(F.lit(k).alias("fold"), role.alias("role")))
    return p.select("*", F.inline(F.array(*roles))).where(F.col("role").isNotNull())


def score_fixed_candidates(folds: DataFrame, target: str, candidates: Mapping[str, str],
                           key="city") -> DataFrame:
    """Fold RMSE of candidates that need no fitting (a column is the
    forecast), on the test rows of each fold."""
    keys = _as_list(key)
    t = folds.where(F.col("role") == "test").where(F.col(target).isNotNull())
    items = [F.struct(F.lit(name).alias("candidate"), F.col(c).cast("double").alias("pred"))
             for name, c in candidates.items()]
    long = t.select(*keys, "fold", F.col(target).alias("y"), F.inline(F.array(*items)))
    return long.groupBy(*keys, "candidate", "fold").agg(
        F.sqrt(F.avg((F.col("y") - F.col("pred")) ** 2)).alias("rmse"))


def score_ridge_one_feature(folds: DataFrame, target: str, feature: str, alpha: float = C.RIDGE_ALPHA,
                            key="city", name: str = "ridge_1f") -> DataFrame:
    """Standardised one-feature ridge fitted per (key, fold) on the train
    rows in closed form (``coef = n*cov/(std*(n+alpha))``), scored on the
    test rows.  The per-fold fit is one aggregate; scoring joins a table of
    (key, fold) size back to the test rows."""
    keys = _as_list(key)
    x, y = F.col(feature).cast("double"), F.col(target)
    tr = folds.where((F.col("role") == "train") & x.isNotNull() & y.isNotNull())
    fit = tr.groupBy(*keys, "fold").agg(F.avg(x).alias("mx"), F.avg(y).alias("my"),
                                        F.covar_pop(x, y).alias("cxy"), F.stddev_pop(x).alias("sx"),
                                        F.count(F.lit(1)).alias("nt"))
    coef = F.try_divide(F.col("nt") * F.col("cxy"), F.col("sx") * (F.col("nt") + F.lit(alpha)))
    fit = fit.select(*keys, "fold", "mx", "my", "sx", coef.alias("coef"))
    te = folds.where((F.col("role") == "test") & x.isNotNull() & y.isNotNull())
    # A constant feature carries no signal: predict the training mean.
    pred = F.col("my") + F.coalesce(F.try_divide(F.col("coef") * (x - F.col("mx")), F.col("sx")), F.lit(0.0))
    return (te.join(fit, keys + ["fold"], "inner").groupBy(*keys, "fold")
              .agg(F.sqrt(F.avg((y - pred) ** 2)).alias("rmse"))
              .select(*keys, F.lit(name).alias("candidate"), "fold", "rmse"))


def select_winner(fold_scores: DataFrame, key="city", order: Mapping[str, int] | None = None) -> DataFrame:
    """Mean fold RMSE per candidate; the winner has the smallest mean
    (ties: candidate listing order, then name)."""
    keys = _as_list(key)
    cv = fold_scores.groupBy(*keys, "candidate").agg(F.avg("rmse").alias("cv_rmse"))
    rank_of = (F.create_map(*[a for k, v in order.items() for a in (F.lit(k), F.lit(v))])[F.col("candidate")]
               if order else F.lit(0))
    # Scores equal up to float noise (e.g. two candidates that coincide on
    # the data) are ties; they fall back to the listing order.
    w = Window.partitionBy(*keys).orderBy(F.round("cv_rmse", 9), rank_of, "candidate")
    return cv.withColumn("rank", F.row_number().over(w)).withColumn("is_winner", F.col("rank") == 1)
