"""Feature attributions as Spark jobs (M12, M16, M17, T02, T04, U03, U04,
J06, W16, F14, P17).

All contributions of an explanation sit in one row, ``(keys...,
horizons: array<struct<horizon, base_value, parts: array<struct<feature, x,
shap_value>>>>)``.  Ranking, cutting, remainder, running total and alignment
across horizons are array functions on that row, so nothing is shuffled.  The
long form ``(keys..., horizon, feature, x, shap_value, base_value)`` is an
``inline`` of it; every function also takes the long form, which is then
gathered once (a row gathers at most one entry per feature and horizon).
"""
from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airlens import constants as C
from airlens.functions import scalars as S
from airlens.operators.clean import _as_list


# M12 / M16 -------------------------------------------------------------------
def explanations(df: DataFrame, weights: Mapping[int, Mapping[str, float]], intercepts: Mapping[int, float],
                 keys=("city", "date"), background: DataFrame | None = None) -> DataFrame:
    """Exact attribution of a linear model against a mean background:
    ``phi_i = w_i * (x_i - mean_i)``, base = prediction at the mean, so
    ``base + sum(phi) = prediction``.  Means are scalar subqueries over the
    background (default: ``df`` itself), evaluated once; the base is computed
    once per horizon."""
    keys = _as_list(keys)
    bg = df if background is None else background
    feats = sorted({f for w in weights.values() for f in w})
    # One scalar subquery returning all means as a struct, referenced once
    # (as a column) so it is planned and executed a single time.
    m = bg.agg(F.struct(*[F.avg(F.col(f).cast("double")).alias(f) for f in feats])).scalar()
    df = df.select(*keys, *feats, m.alias("_means"))
    horizons = []
    for h, w in sorted(weights.items()):
        base = F.lit(float(intercepts.get(h, 0.0)))
        for f, wf in w.items():
            base = base + F.lit(float(wf)) * F.col("_means")[f]
        parts = []
        for f, wf in sorted(w.items()):
            x = F.col(f).cast("double")
            parts.append(F.struct(F.lit(f).alias("feature"), x.alias("x"),
                                  (F.lit(float(wf)) * (x - F.col("_means")[f])).alias("shap_value")))
        horizons.append(F.struct(F.lit(h).alias("horizon"), base.alias("base_value"), F.array(*parts).alias("parts")))
    return df.select(*keys, F.array(*horizons).alias("horizons"))


def contributions(explained: DataFrame, keys=("city", "date")) -> DataFrame:
    """The long form: one row per horizon and feature."""
    keys = _as_list(keys)
    h = explained.select(*keys, F.inline("horizons"))
    return (h.select(*keys, "horizon", "base_value", F.inline("parts"))
            .select(*keys, "horizon", "feature", "x", "shap_value", "base_value"))


def linear_contributions(df: DataFrame, weights, intercepts, keys=("city", "date"),
                         background: DataFrame | None = None) -> DataFrame:
    return contributions(explanations(df, weights, intercepts, keys, background), keys)


def _explained(df: DataFrame, keys: list[str]) -> DataFrame:
    if "horizons" in df.columns:
        return df
    by = df.groupBy(*keys, "horizon").agg(
        F.first("base_value").alias("base_value"),
        F.collect_list(F.struct("feature", (F.col("x") if "x" in df.columns else F.lit(None).cast("double")).alias("x"),
                                "shap_value")).alias("parts"))
    return by.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("horizon", "base_value", "parts"))).alias("horizons"))


def _by_size(parts: Column) -> Column:
    """Contributions by falling magnitude, ties by name, nulls last."""
    def key(p):
        return F.struct(F.coalesce(-F.abs(p["shap_value"]), F.lit(float("inf"))).alias("k"), p["feature"].alias("feature"),
                        p["x"].alias("x"), p["shap_value"].alias("shap_value"))
    return F.array_sort(F.transform(parts, key))


def _rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per explanation: keys, horizon, base_value, ranked."""
    h = _explained(df, keys).select(*keys, F.inline("horizons"))
    return h.select(*keys, "horizon", "base_value", _by_size(F.col("parts")).alias("ranked"))


def predictions_from_contributions(contrib: DataFrame, keys=("city", "date")) -> DataFrame:
    """Efficiency property: prediction = base + sum of contributions."""
    keys = _as_list(keys)
    r = _rows(contrib, keys)
    total = F.aggregate("ranked", F.lit(0.0), lambda acc, p: acc + F.coalesce(p["shap_value"], F.lit(0.0)))
    return r.select(*keys, "horizon", (F.col("base_value") + total).alias("prediction"), "base_value")


def base_values(predictions: DataFrame) -> DataFrame:
    """Expected value = mean prediction over the background rows."""
    return predictions.groupBy("horizon").agg(F.avg("prediction").alias("base_value"))


# T02 / T04 -------------------------------------------------------------------
def top_contributions(contrib: DataFrame, n: int = 10, keys=("city", "date")) -> DataFrame:
    """The ``n`` largest contributions of each explanation, with their rank."""
    keys = _as_list(keys)
    r = _rows(contrib, keys).select(*keys, "horizon", "base_value", F.posexplode(F.slice("ranked", 1, n)).alias("_at", "_p"))
    return r.select(*keys, "horizon", F.col("_p.feature").alias("feature"), F.col("_p.x").alias("x"),
                    F.col("_p.shap_value").alias("shap_value"), "base_value", (F.col("_at") + 1).alias("rank"),
                    F.abs("_p.shap_value").alias("abs_shap"))


# M17 / U03 / P17 / W16 --------------------------------------------------------
def waterfall(contrib: DataFrame, n: int = 10, keys=("city", "date")) -> DataFrame:
    """Top-n bars, one remainder bar for the other features when its sum
    exceeds 0.01 in magnitude, and the running total from the base value."""
    keys = _as_list(keys)
    bar = lambda name, v: F.struct(name.alias("feature"), v.alias("shap_value"))
    r = _rows(contrib, keys).withColumn("_rest", F.aggregate(
        F.slice("ranked", n + 1, F.greatest(F.size("ranked"), F.lit(1))), F.lit(0.0), lambda acc, p: acc + p["shap_value"]))
    top = F.transform(F.slice("ranked", 1, n), lambda p: bar(p["feature"], p["shap_value"]))
    rest = F.array(bar(F.lit(C.WATERFALL_OTHER_NAME), F.col("_rest")))
    r = r.withColumn("_bars", F.when(F.abs("_rest") > C.WATERFALL_OTHER_MIN, F.concat(top, rest)).otherwise(top))
    r = r.withColumn("_sums", F.transform("_bars", lambda b, i: F.col("base_value") + F.aggregate(
        F.slice("_bars", F.lit(1), i + 1), F.lit(0.0), lambda acc, p: acc + p["shap_value"])))
    r = r.select(*keys, "horizon", "base_value", F.posexplode(F.arrays_zip("_bars", "_sums")).alias("_at", "_b"))
    return r.select(*keys, "horizon", (F.col("_at") + 1).alias("rank"), F.col("_b._bars.feature").alias("feature"),
                    F.col("_b._bars.shap_value").alias("shap_value"), "base_value", F.col("_b._sums").alias("running_total"))


# F14 -------------------------------------------------------------------------
def insight(contrib: DataFrame, n: int = 3, keys=("city", "date")) -> DataFrame:
    """One sentence per explanation from the top-``n`` contributions; without
    any, the sentences of the two empty cases."""
    keys = _as_list(keys)
    phrase = F.transform(F.slice("ranked", 1, n), lambda p: S.contribution_phrase(p["feature"], p["shap_value"]))
    text = (F.when(F.col("ranked").isNull(), F.lit(C.INSIGHT_UNAVAILABLE))
             .when(F.size("ranked") == 0, F.lit(C.INSIGHT_NO_FEATURE))
             .otherwise(F.concat(F.lit("For day "), F.col("horizon").cast("string"), F.lit(": "),
                                 F.concat_ws(", and ", phrase), F.lit("."))))
    return _rows(contrib, keys).select(*keys, "horizon", text.alias("insight"))


# J06 / U04 -------------------------------------------------------------------
def align_top_features(contrib: DataFrame, n: int = 5, keys=("city", "date"), horizons=(1, 2, 3)) -> DataFrame:
    """Features in the top-``n`` of any horizon (distinct union), with their
    contribution per horizon side by side; absent -> 0."""
    keys = _as_list(keys)
    tops = F.flatten(F.transform("horizons", lambda h: F.transform(F.slice(_by_size(h["parts"]), 1, n), lambda p: p["feature"])))
    e = _explained(contrib, keys).select(*keys, "horizons", F.explode(F.array_distinct(tops)).alias("feature"))

    def value(h):
        of = F.flatten(F.transform(F.filter("horizons", lambda x: x["horizon"] == h), lambda x: x["parts"]))
        own = F.filter(of, lambda p: p["feature"] == F.col("feature"))
        return F.coalesce(F.get(own, F.lit(0))["shap_value"], F.lit(0.0)).alias(f"day{h}")
    return e.select(*keys, "feature", *[value(h) for h in horizons])
