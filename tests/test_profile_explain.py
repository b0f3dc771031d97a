"""Quartiles, metrics of constant actuals, rollup without a column, explanations in both forms."""
import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from airlens import constants as C
from airlens.operators import evaluate as EV
from airlens.operators import explain as EX
from airlens.operators import profile as PR
from airlens.operators.rollup import daily_rollup


@pytest.mark.parametrize("cuts", [2, 7, 256])
def test_quantiles_equal_numpy(spark, cuts):
    rnd = random.Random(cuts)
    rows = [(g, float(rnd.choice([rnd.randint(0, 9), rnd.gauss(0, 5)]))) for g in "abc" for _ in range(rnd.choice([1, 2, 150]))]
    rows += [("d", 4.0)] * 40 + [("e", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    probs = (0.0, 0.25, 0.5, 0.9, 1.0)
    got = {r.g: r._q for r in PR.exact_quantiles(df, F.col("x"), probs, "g", cuts).collect()}
    assert set(got) == {"a", "b", "c", "d"}
    for g, q in got.items():
        assert q == pytest.approx(np.quantile([x for k, x in rows if k == g], probs))
    every = PR.exact_quantiles(df, F.col("x"), probs, None, cuts).collect()[0]._q
    assert every == pytest.approx(np.quantile([x for _, x in rows if x is not None], probs))


def test_box_of_nothing(spark):
    df = spark.createDataFrame([], "g string, x double")
    assert PR.box_stats(df, "x").count() == 0 and PR.box_stats(df, "x", by="g").count() == 0


def test_ranked_correlations(spark):
    df = spark.createDataFrame([(float(k), float(-2 * k), float(k % 3), 1.0) for k in range(20)], "a double, b double, c double, k double")
    got = {(r.feature, r.target): r["rank"] for r in PR.ranked_correlations(PR.correlations(df, ["b", "c", "k"], ["a"], batch=2)).collect()}
    assert got == {("b", "a"): 1, ("c", "a"): 2, ("k", "a"): 3}


def test_constant_actuals(spark):
    df = spark.createDataFrame([(1, 5.0, 5.0), (1, 5.0, 5.0), (2, 5.0, 6.0), (2, 5.0, 5.0)], "horizon int, actual double, predicted double")
    assert {r.horizon: r.r2 for r in EV.regression_metrics(df).collect()} == {1: 1.0, 2: 0.0}


def test_rollup_without_precipitation(spark):
    cols = [m for m in C.MEASURES if m != "precipitation"]
    df = spark.createDataFrame([("a", dt.datetime(2024, 1, 1, h), *[float(h)] * len(cols)) for h in range(3)],
                               "city string, timestamp timestamp_ntz, " + ", ".join(f"{c} double" for c in cols))
    assert daily_rollup(df).first()["precip_sum"] is None


def test_both_forms_of_explanations_agree(spark):
    rnd = random.Random(1)
    df = spark.createDataFrame([("a", dt.date(2024, 1, d), *[rnd.gauss(0, 3) for _ in range(6)]) for d in range(1, 9)],
                               "city string, date date, " + ", ".join(f"x{k} double" for k in range(6)))
    weights = {h: {f"x{k}": h * 0.5 + k for k in range(6)} for h in (1, 2)}
    wide = EX.explanations(df, weights, {1: 1.0, 2: 2.0})
    long = EX.contributions(wide)
    for fn in (EX.top_contributions, EX.waterfall, EX.align_top_features):
        a, b = (sorted(map(tuple, (tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in fn(x, 2).collect())), key=repr)
                for x in (wide, long))
        assert a == b and a
    assert EX.insight(wide).filter("insight not like 'For day %: x% AQI points.'").count() == 0
    empty = wide.select("city", "date", F.transform("horizons", lambda h: F.struct(
        h["horizon"].alias("horizon"), h["base_value"].alias("base_value"), F.slice(h["parts"], 1, 0).alias("parts"))).alias("horizons"))
    assert {r.insight for r in EX.insight(empty).collect()} == {C.INSIGHT_NO_FEATURE}
    assert "Exchange" not in EX.waterfall(wide)._jdf.queryExecution().sparkPlan().toString().split("Subquery")[0]
