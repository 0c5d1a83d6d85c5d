import json

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from panelcast.operators import forecast as fc
from panelcast.operators.normal_equations import Moments, moments
from panelcast.operators.timeseries import fold_bounds
from panelcast.schemas import KEYS, TIME, VALUE
from tests.test_forecast import panel  # noqa: F401


def numbers(rows=400, width=6, seed=5):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(rows, width)) * np.array([1, 10, 0.1, 1000, 1, 3]) + np.array([0, 5, 1, 1e6, 2, -9])
    x[:, 4] = 2.0  # never varies
    return np.column_stack([x, x @ [1, -2, 30, 0.01, 7, 0] + rng.normal(size=rows)])


def test_states_merge_in_any_grouping():
    data = numbers()
    whole = Moments.of(data)
    for cuts in ([100], [1, 2, 3], [399], [50, 200, 201]):
        total = Moments.none(7)
        for part in np.split(data, cuts):
            total = total.merge(Moments.of(part))
        assert total.n == whole.n and np.allclose(total.mean, whole.mean) and np.allclose(total.scatter, whole.scatter)
    assert Moments.none(7).merge(whole).n == 400 and whole.merge(Moments.none(7)).n == 400
    assert np.allclose(np.cov(data.T, ddof=0), whole.scatter / 400)


@pytest.mark.parametrize("penalty", [0.0, 0.01, 0.5, 20.0])
def test_ridge_equals_the_library(spark, penalty):
    data = numbers()
    df = spark.createDataFrame([(i % 3, [float(v) for v in r[:-1]], float(r[-1])) for i, r in enumerate(data)], "s int, x array<double>, y double")
    found = moments(df.repartition(5), "s", "x", "y", 7)
    total = Moments.none(7)
    for s in range(3):
        assert found[s].n == sum(i % 3 == s for i in range(400))
        total = total.merge(found[s])
    ours, intercept = total.ridge(penalty)
    learned = LinearRegression(regParam=penalty, solver="normal", labelCol="y").fit(df.select(array_to_vector("x").alias("features"), "y"))
    assert np.allclose(ours, learned.coefficients.toArray(), atol=1e-6) and intercept == pytest.approx(learned.intercept, rel=1e-6)
    assert np.abs(total.gradient(ours, penalty)).max() < 1e-9
    assert np.allclose(total.only([3, 0]).ridge(penalty)[0], Moments.of(data[:, [3, 0, 6]]).ridge(penalty)[0])


def test_no_rows_and_null_segments(spark):
    df = spark.createDataFrame([(None, [1.0], 2.0)], "s int, x array<double>, y double")
    assert moments(df, "s", "x", "y", 2) == {}
    coefficients, intercept = Moments.none(3).ridge(1.0)
    assert coefficients.tolist() == [0.0, 0.0] and intercept == 0.0


def test_solved_model_equals_the_fitted_pipeline(panel):  # noqa: F811
    config = {"reg_lambda": 0.01}
    solved, fitted = fc.solve(panel, config), fc.fit(panel, config)
    assert np.allclose(solved.coefficients, fitted.stages[-1].coefficients.toArray(), atol=1e-6)
    assert solved.intercept == pytest.approx(fitted.stages[-1].intercept, rel=1e-6)
    a, b = ([r[VALUE] for r in fc.forecast(m, panel).orderBy(*KEYS, TIME).collect()] for m in (solved, fitted))
    assert np.allclose(a, b, atol=1e-6) and len(a) == 72


def test_all_linear_trials_from_one_pass(panel, monkeypatch):  # noqa: F811
    """Penalties, folds and sets of features; each trial equals a fit and a forecast of its own."""
    passes = []
    monkeypatch.setattr(fc, "moments", lambda *a: passes.append(1) or moments(*a))
    configs = [{"config_id": 0, "reg_lambda": 0.0}, {"config_id": 1, "reg_lambda": 0.015}, {"config_id": 2, "reg_lambda": 0.5, "std": ((1, 72),), "keys": False},
               {"config_id": 3, "reg_lambda": 0.015, "mean": (), "lag": (1, 24, 72)}]
    got = {(r["config_id"], r["fold"]): r for r in fc.cross_validate(panel, configs).collect()}
    assert len(passes) == 1 and len(got) == 12
    for config in configs[1:]:
        for fold in fold_bounds(panel).collect():
            hours = F.timestamp_diff("HOUR", F.lit(str(fold["origin"])).cast("timestamp_ntz"), F.col(TIME))
            train = panel.where(hours < fold["train_end"])
            test = panel.where((hours >= fold["train_end"]) & (hours < fold["test_end"]))
            own = {"std": fc.GRID_STD_WINDOWS, **config}
            want = fc.score(fc.evaluate(fc.fit(train, own), train, test)).first()["MAPE"]
            row = got[config["config_id"], fold["fold"]]
            assert row["MAPE"] == pytest.approx(want, rel=1e-6) and json.loads(row["config"])["reg_lambda"] == config["reg_lambda"]
