"""Model layer properties: ridge closed form, chain guard, attribution efficiency."""
import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from airlens.modeling import models as MD


@pytest.fixture(scope="module")
def frame(spark):
    rnd = random.Random(7)
    rows = []
    for city in ("a", "b"):
        for i in range(120):
            x1, x2 = rnd.uniform(0, 10), rnd.uniform(-5, 5)
            rows.append((city, dt.date(2024, 1, 1) + dt.timedelta(days=i), x1, x2, 3 * x1 - 2 * x2 + rnd.gauss(0, 0.5)))
    return spark.createDataFrame(rows, "city string, date date, x1 double, x2 double, aqi_day1 double")


def test_ridge_matches_numpy(frame):
    m = MD.fit(frame, ["x1", "x2"], "aqi_day1", "ridge", {"alpha": 10.0})
    pdf = frame.toPandas()
    X = pdf[["x1", "x2"]].to_numpy()
    y = pdf["aqi_day1"].to_numpy()
    mu, sd = X.mean(0), X.std(0)
    Z = (X - mu) / sd
    w = np.linalg.solve(Z.T @ Z + 10.0 * np.eye(2), Z.T @ (y - y.mean()))
    assert np.allclose(m.stages[-1].coefficients.toArray(), w / sd, rtol=1e-6)


def test_chain_refuses_targets_as_extra(frame):
    with pytest.raises(ValueError):
        MD.train_best_model(frame, "aqi_day1", ["x1"], {"ridge": [{}]}, extra_features=["aqi_day2"])


@pytest.mark.parametrize("family,params", [("ridge", {"alpha": 1.0}), ("gradient_boosting", {"maxIter": 3, "maxDepth": 2})])
def test_attributions_add_up(spark, frame, family, params):
    m = MD.fit(frame, ["x1", "x2"], "aqi_day1", family, params)
    rows = frame.where(F.col("date") == dt.date(2024, 4, 1))
    phi = MD.permutation_attributions(m, rows, frame, ["x1", "x2"], n_perm=4, max_background=8)
    got = phi.groupBy("city", "date").agg((F.first("base_value") + F.sum("shap_value")).alias("s"))
    pred = MD.predict(m, rows).select("city", "date", "prediction")
    for r in got.join(pred, ["city", "date"]).collect():
        assert r.s == pytest.approx(r.prediction, abs=1e-9)


def test_linear_attribution_exact(spark, frame):
    m = MD.fit(frame, ["x1", "x2"], "aqi_day1", "ridge", {"alpha": 1.0})
    rows = frame.where(F.col("date") == dt.date(2024, 4, 1))
    phi, kind = MD.explain(m, rows, frame, ["x1", "x2"])
    assert kind == "linear"
    s = phi.groupBy("city", "date").agg((F.first("base_value") + F.sum("shap_value")).alias("s"))
    pred = MD.predict(m, rows).select("city", "date", "prediction")
    for r in s.join(pred, ["city", "date"]).collect():
        assert r.s == pytest.approx(r.prediction, abs=1e-6)
