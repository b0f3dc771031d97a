"""Model competition, multi-horizon chain, scoring and attribution with
``pyspark.ml`` (M01-M11, M13-M15).

Every fit is a distributed Spark ML job; the driver only loops over the
(small, fixed) grid of candidates and folds, several fits at a time, as a
tuning harness does.  The folds of a horizon are written once to the shared
folder, so the many fits neither recompute the feature plan nor its windows
and survive executor loss.  Statistics that reach the driver are bounded: one
mean per feature, two numbers per ridge fit, a few scores per fit.

A stored pipeline holds all that scoring needs: the first stage fills nulls
with the training means, the second fixes the feature order.
"""
from __future__ import annotations

import json
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from typing import Mapping, Sequence

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import (GBTRegressor, LinearRegression, LinearRegressionModel,
                                   RandomForestRegressor)
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airlens import constants as C
from airlens.functions import scalars as S
from airlens.modeling.moments import ridge_cv
from airlens.modeling.selection import expanding_folds, positions, time_split
from airlens.operators.clean import _as_list
from airlens.operators.features import check_leakage
from airlens.session import materialise


# M01 / F16 -------------------------------------------------------------------
def fit_means(train: DataFrame, cols: Sequence[str]) -> dict:
    """Column means on the training rows (one aggregate, one number per
    column); an all-null column gets 0."""
    row = train.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in cols]).first()
    return {c: (row[c] if row[c] is not None else 0.0) for c in cols}


def impute(df: DataFrame, cols: Sequence[str], means: Mapping[str, float]) -> DataFrame:
    """Null -> training mean -> 0; absent column -> 0."""
    sel = [c for c in df.columns if c not in cols]
    for c in cols:
        src = F.col(c).cast("double") if c in df.columns else F.lit(None).cast("double")
        sel.append(S.fill_mean_then_zero(src, F.lit(float(means.get(c, 0.0)))).alias(c))
    return df.select(*sel)


# P14 -------------------------------------------------------------------------
def feature_columns(df: DataFrame, target: str, listed: Sequence[str] = tuple(C.FEATURE_COLS),
                    exclude: Sequence[str] = ()) -> tuple[list, list]:
    """Listed, present, numeric, not a target and not excluded -> used;
    listed but absent -> reported as missing."""
    from pyspark.sql.types import NumericType
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)}
    bad = set(C.TARGETS) | {target} | set(exclude)
    used = [c for c in listed if c in numeric and c not in bad]
    missing = [c for c in listed if c not in df.columns]
    return used, missing


# M03-M07 ---------------------------------------------------------------------
def make_estimator(family: str, params: Mapping, label: str, train: DataFrame | None = None):
    if family == "ridge":
        # Standardised ridge with penalty alpha (sum of squares scale):
        # Spark's objective is 1/(2n)||r||^2 + lambda/2 ||w||^2 on a label
        # scaled by its population std, hence lambda = alpha / n * std(y).
        st = train.agg(F.count(F.col(label)).alias("n"), F.stddev_pop(label).alias("sd")).first()
        sd = st["sd"] or 1.0
        reg = float(params.get("alpha", C.RIDGE_ALPHA)) / max(st["n"], 1) * sd
        return LinearRegression(featuresCol="features", labelCol=label, regParam=reg, elasticNetParam=0.0,
                                standardization=True, solver="normal")
    if family in ("random_forest",):
        return RandomForestRegressor(featuresCol="features", labelCol=label, seed=C.RANDOM_SEED, **params)
    p = dict(params)
    if family == "xgboost_role":
        p.setdefault("featureSubsetStrategy", "0.8")
        p.setdefault("minInstancesPerNode", 3)
    return GBTRegressor(featuresCol="features", labelCol=label, seed=C.RANDOM_SEED, **p)


IN = "__in"


def imputer(features: Sequence[str], means: Mapping[str, float]) -> SQLTransformer:
    """F16 as a pipeline stage: null -> training mean, into ``<name>__in``."""
    filled = ", ".join(f"coalesce(CAST(`{f}` AS DOUBLE), {float(means.get(f, 0.0))!r}D) AS `{f}{IN}`" for f in features)
    return SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__")


def fit(train: DataFrame, features: Sequence[str], label: str, family: str, params: Mapping,
        means: Mapping[str, float] | None = None) -> PipelineModel:
    means = fit_means(train, features) if means is None else means
    asm = VectorAssembler(inputCols=[f + IN for f in features], outputCol="features")
    est = make_estimator(family, params, label, train)
    return Pipeline(stages=[imputer(features, means), asm, est]).fit(train)


def model_features(model: PipelineModel) -> list[str]:
    """The features of a (stored) pipeline, in its order."""
    return [c[:-len(IN)] for c in model.stages[1].getInputCols()]


def predict(model: PipelineModel, df: DataFrame, name: str = "prediction") -> DataFrame:
    """``df`` with the pipeline's prediction; absent features count as 0."""
    absent = [f for f in model_features(model) if f not in df.columns]
    x = df.select("*", *[F.lit(0.0).alias(f) for f in absent])
    return model.transform(x).select(*[F.col(c) for c in df.columns if c != name], F.col("prediction").alias(name))


def rmse(model: PipelineModel, df: DataFrame, label: str) -> float:
    p = model.transform(df)
    return p.agg(F.sqrt(F.avg((F.col(label) - F.col("prediction")) ** 2))).first()[0]


def test_metrics(model: PipelineModel, df: DataFrame, label: str) -> dict:
    """A08 on held-out rows, one aggregate; constant actuals give R2 = 1 when
    exact, else 0."""
    p = model.transform(df)
    e = F.col(label) - F.col("prediction")
    ss, tot = F.sum(e * e), F.var_pop(label) * F.count(F.lit(1))
    r2 = F.when(tot > 0, F.lit(1.0) - F.try_divide(ss, tot)).when(ss == 0, F.lit(1.0)).when(ss > 0, F.lit(0.0))
    r = p.agg(F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"), r2.alias("r2")).first()
    return {k: (round(r[k], 4) if r[k] is not None else None) for k in ("rmse", "mae", "r2")}


# M02 -------------------------------------------------------------------------
def cv_score(folds: DataFrame, features, label, family, params, means, n_splits: int = C.CV_SPLITS) -> float:
    """Mean RMSE over expanding folds (fit on train rows, score test rows)."""
    scores = []
    for k in range(1, n_splits + 1):
        tr = folds.where((F.col("fold") == k) & (F.col("role") == "train"))
        te = folds.where((F.col("fold") == k) & (F.col("role") == "test"))
        scores.append(rmse(fit(tr, features, label, family, params, means), te, label))
    return float(np.mean(scores))


def scaled(grids: Mapping[str, list], rounds: float) -> dict:
    """The grids with the number of trees or iterations times ``rounds`` (2 at
    least): every point stays, at a fraction of its cost."""
    size = ("maxIter", "numTrees")
    return {f: [{k: max(2, round(v * rounds)) if k in size else v for k, v in p.items()} for p in points]
            for f, points in grids.items()}


# M08 -------------------------------------------------------------------------
@dataclass
class Trained:
    target: str
    model: PipelineModel
    model_name: str
    params: dict
    features: list
    means: dict
    scores: dict
    candidates: list = field(default_factory=list)  # one dict per grid point
    rows: dict = field(default_factory=dict)


def train_best_model(df: DataFrame, target: str, features: Sequence[str] = tuple(C.FEATURE_COLS),
                     grids: Mapping[str, list] = C.MODEL_GRIDS, key="city", order: str = "date",
                     extra_features: Sequence[str] = (), min_rows: int = C.MIN_TRAIN_ROWS,
                     parallelism: int = 8) -> Trained:
    """Competition: every grid point scored by expanding-window CV on the
    training part (first 80 % of each key), fitted on that part and scored on
    the test part; winner = lowest CV RMSE (first on ties).  ``parallelism``
    fits run at a time."""
    t0 = time.time()
    bad = [c for c in extra_features if c in C.TARGETS]
    if bad:
        raise ValueError(f"targets cannot be extra features: {bad}")
    feats = feature_columns(df, target, features)[0] + list(extra_features)
    check_leakage(feats, severity="warning")
    keys = _as_list(key)
    data = df.where(F.col(target).isNotNull()).select(*keys, order, target, *feats)
    split = materialise(time_split(data, keys, order), "split")
    train, test = split.where("is_train").drop("rn", "n", "is_train"), split.where(~F.col("is_train"))
    means = fit_means(train, feats)                     # Q05: training rows only
    n_train, n_test = train.count(), test.count()
    if n_train < min_rows:
        raise ValueError(f"only {n_train} training rows for {target}; need {min_rows}")
    folds = materialise(expanding_folds(train, keys, order), "folds").persist(StorageLevel.MEMORY_AND_DISK)
    sizes = {(r["fold"], r["role"]): r["count"] for r in folds.groupBy("fold", "role").count().collect()}

    alphas = [float(p.get("alpha", C.RIDGE_ALPHA)) for p in grids.get("ridge", [])]
    ridges = ridge_cv(train, feats, target, means, alphas, keys, order) if alphas else {}

    def run(point):
        family, params = point
        # Ridge folds come from block moments: one pass for all of them.
        cv = (float(np.mean(ridges[float(params.get("alpha", C.RIDGE_ALPHA))])) if family == "ridge"
              else cv_score(folds, feats, target, family, params, means))
        model = fit(train, feats, target, family, params, means)
        return dict(family=family, params=params, cv_rmse=cv, model=model, **test_metrics(model, test, target))

    points = [(family, dict(p)) for family, ps in grids.items() for p in ps]
    with ThreadPoolExecutor(max(1, min(parallelism, len(points)))) as pool:
        cands = list(pool.map(run, points))
    folds.unpersist()
    best = min(cands, key=lambda c: c["cv_rmse"])       # first on ties
    scores = {k: best[k] for k in ("rmse", "mae", "r2")}
    scores.update(model_name=best["family"], params=json.dumps(best["params"]), cv_rmse=round(best["cv_rmse"], 4),
                  feature_count=len(feats), data_rows_used=n_train + n_test,
                  training_duration_seconds=round(time.time() - t0, 2))
    return Trained(target, best["model"], best["family"], best["params"], feats, means, scores,
                   [{k: v for k, v in c.items() if k != "model"} for c in cands],
                   {"train": n_train, "test": n_test, "folds": sizes})


def candidates_frame(spark, trained: Sequence[Trained]) -> DataFrame:
    """Candidate table: one row per target and grid point, built from the
    bounded list of fit results."""
    rows = [(t.target, k, c["family"], json.dumps(c["params"]), float(c["cv_rmse"]), c["rmse"], c["mae"], c["r2"],
             c["family"] == t.model_name and c["params"] == t.params)
            for t in trained for k, c in enumerate(t.candidates)]
    return spark.createDataFrame(rows, "target string, point int, model string, params string, cv_rmse double, "
                                       "test_rmse double, test_mae double, test_r2 double, is_winner boolean")


def metadata_frame(spark, trained: Sequence[Trained], trained_at) -> DataFrame:
    """K08 rows of the winners, features in their order."""
    rows = [(t.target, t.scores["model_name"], t.scores["params"], t.scores["cv_rmse"], t.scores["rmse"], t.scores["mae"],
             t.scores["r2"], t.scores["feature_count"], t.features, t.scores["data_rows_used"],
             t.scores["training_duration_seconds"], trained_at) for t in trained]
    return spark.createDataFrame(rows, "target string, model_name string, params string, cv_rmse double, test_rmse double, "
                                       "test_mae double, test_r2 double, feature_count int, features array<string>, "
                                       "data_rows_used long, training_duration_seconds double, trained_at timestamp_ntz")


# M09 -------------------------------------------------------------------------
def prediction_name(target: str) -> str:
    return "pred_" + target.replace("aqi_", "")


def out_of_fold(df: DataFrame, trained: Trained, name: str, key="city", order: str = "date", blocks: int = C.CV_SPLITS + 1) -> DataFrame:
    """``df`` with predictions by models of ``trained``'s kind that did not see
    the row: each key's rows are cut into ``blocks`` runs of days, and a block is
    predicted by a model fitted on the rows of all other blocks (their means
    fill the nulls)."""
    keys = _as_list(key)
    part = F.floor((F.col("rn") - 1) * blocks / F.col("n")).cast("int")
    rows = materialise(positions(df, keys, order).withColumn("_block", part).drop("rn", "n"), "blocks")
    out = []
    for b in range(blocks):
        others = rows.where((F.col("_block") != b) & F.col(trained.target).isNotNull())
        model = fit(others, trained.features, trained.target, trained.model_name, trained.params)
        out.append(predict(model, rows.where(F.col("_block") == b), name).drop("_block"))
    return reduce(DataFrame.unionByName, out)


def train_chain(df: DataFrame, features: Sequence[str] = tuple(C.FEATURE_COLS), grids: Mapping[str, list] = C.MODEL_GRIDS,
                key="city", order: str = "date", targets: Sequence[str] = tuple(C.TARGETS), chained: str = "in_sample",
                **kw) -> tuple[list, DataFrame]:
    """Horizon h is trained with the predictions of horizons < h as extra
    features (``pred_day1``, ``pred_day2``); returns the trained models and
    the frame with the prediction columns added.  ``chained`` is 'in_sample'
    (the fitted winner's, Q06) or 'out_of_fold' (:func:`out_of_fold`)."""
    if chained not in ("in_sample", "out_of_fold"):
        raise ValueError(f"chained is {chained!r}")
    out, cur, extra = [], df, []
    for t in targets:
        tr = train_best_model(cur, t, features, grids, key, order, extra_features=extra, **kw)
        out.append(tr)
        name = prediction_name(t)
        more = predict(tr.model, cur, name) if chained == "in_sample" else out_of_fold(cur, tr, name, key, order)
        cur = materialise(more, "chain")
        extra = extra + [name]
    return out, cur


# M10 -------------------------------------------------------------------------
def score_chain(rows: DataFrame, chain: Mapping[str, PipelineModel], key="city") -> DataFrame:
    """Chained predictions for the given rows (e.g. the latest row of each
    key) by target -> pipeline, in horizon order; interior steps use unclamped
    values, the outputs are clamped at 0 (Q18) and labelled (F04)."""
    cur, outs = rows, []
    for i, (target, model) in enumerate(chain.items(), start=1):
        name = prediction_name(target)
        cur = predict(model, cur, name)
        v = S.clamp_non_negative(name)
        outs.append(F.struct(v.alias("aqi"), S.aqi_label(v).alias("label")).alias(f"day{i}"))
    return cur.select(*_as_list(key), *[c for c in ("date",) if c in cur.columns], *outs)


# M11 -------------------------------------------------------------------------
def save(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


# M12 / M13 / M14 / M15 / M16 -------------------------------------------------
def filled(model: PipelineModel, df: DataFrame, keys) -> DataFrame:
    """Keys and features, nulls filled as the pipeline fills them."""
    x = model.stages[0].transform(df)
    return x.select(*keys, *[F.col(f + IN).alias(f) for f in model_features(model)])


def linear_attributions(model: PipelineModel, rows: DataFrame, background: DataFrame,
                        features: Sequence[str], key=("city", "date")) -> DataFrame:
    """Exact attribution for a fitted linear model: coef_i * (x_i - mean_i)
    (coefficients are in the original feature space).  The filled rows are
    written first: the optimizer's constraints would else combine every
    feature with its filled form."""
    from airlens.operators.explain import linear_contributions
    keys, lm = _as_list(key), model.stages[-1]
    w = {1: {f: float(c) for f, c in zip(features, lm.coefficients.toArray())}}
    return linear_contributions(materialise(filled(model, rows, keys), "explained"), w, {1: float(lm.intercept)}, key,
                                materialise(filled(model, background, []), "background")).drop("horizon")


def recent_background(features: DataFrame, as_of, days: int = 30, order: str = "date") -> DataFrame:
    """The reference rows of an explanation: the last ``days`` days."""
    ref = F.lit(as_of).cast("date") if isinstance(as_of, str) else F.lit(as_of)
    return features.where(F.col(order) > F.date_sub(ref, days))


def permutation_attributions(model: PipelineModel, rows: DataFrame, background: DataFrame,
                             features: Sequence[str], key=("city", "date"), n_perm: int = 8,
                             max_background: int = 50, seed: int = C.RANDOM_SEED) -> DataFrame:
    """Model-agnostic sampled-permutation Shapley values.

    For every explained row, background row ``b`` (at most
    ``max_background``, a bounded sample that is embedded as literals) and
    permutation ``p``, the coalition path switches features from the
    background to the row one at a time; one ``transform`` scores all path
    points, ``lag`` over the (d+1)-row path gives each feature's marginal
    change, and the average over (b, p) is its value.  Base = mean
    prediction with every feature from the background, so
    ``base + sum(phi) = prediction`` holds exactly.  Nulls count as the
    pipeline's own means on both sides."""
    keys, feats = _as_list(key), list(features)
    d, rng = len(feats), np.random.RandomState(seed)
    bg = (background.select(*[F.col(f).cast("double").alias(f) for f in feats])
          .orderBy(F.xxhash64(*feats, F.lit(seed)), *feats).limit(max_background).collect())
    value = lambda v: "CAST(NULL AS DOUBLE)" if v is None else f"CAST('{float(v)!r}' AS DOUBLE)"
    array = lambda items: "array(" + ", ".join(items) + ")"
    grounds = array([f"named_struct('_b', {k}, '_bg', {array([value(r[f]) for f in feats])})" for k, r in enumerate(bg)])
    perms = [rng.permutation(d) for _ in range(n_perm)]
    orders = array([f"named_struct('_p', {k}, '_perm', {array([str(i) for i in p])}, '_pos', "
                    f"{array([str(i) for i in np.argsort(p)])})" for k, p in enumerate(perms)])
    names = array([f"'{f}'" for f in feats])
    x = rows.select(*keys, F.array(*[F.col(f).cast("double") for f in feats]).alias("_x"))
    x = x.select("*", F.expr(f"inline({grounds})")).select("*", F.expr(f"inline({orders})"))
    x = x.select("*", F.explode(F.sequence(F.lit(0), F.lit(d))).alias("_j"))
    feat = F.expr(f"CASE WHEN _j > 0 THEN {names}[_perm[_j - 1]] ELSE '' END").alias("_feat")
    vals = [F.when(F.col("_pos")[i] < F.col("_j"), F.col("_x")[i]).otherwise(F.col("_bg")[i]).alias(f)
            for i, f in enumerate(feats)]
    pred = model.transform(x.select(*keys, "_b", "_p", "_j", feat, *vals))
    w = Window.partitionBy(*keys, "_b", "_p").orderBy("_j")
    marg = pred.select(*keys, "_j", "_feat", "prediction",
                       (F.col("prediction") - F.lag("prediction").over(w)).alias("_m"))
    phi = marg.where(F.col("_j") > 0).groupBy(*keys, F.col("_feat").alias("feature")).agg(
        F.avg("_m").alias("shap_value"))
    base = marg.where(F.col("_j") == 0).groupBy(*keys).agg(F.avg("prediction").alias("base_value"))
    return phi.join(base, keys, "inner")


def explain(model: PipelineModel, rows: DataFrame, background: DataFrame, features: Sequence[str],
            key=("city", "date"), **kw) -> tuple[DataFrame, str]:
    """Exact linear attribution for linear models, sampled
    permutations for everything else (trees included: interventional
    values, the same interface) and where the linear one fails."""
    if isinstance(model.stages[-1], LinearRegressionModel):
        try:
            return linear_attributions(model, rows, background, features, key), "linear"
        except (ValueError, KeyError, AnalysisException):
            pass
    return permutation_attributions(model, rows, background, features, key, **kw), "permutation"
