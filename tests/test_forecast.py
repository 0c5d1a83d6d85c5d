import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.operators import forecast as fc, hooks, joins
from panelcast.operators.aggregates import score
from panelcast.operators.trees import FlatTrees
from panelcast.plans import monitoring, pages, prediction, training
from panelcast.schemas import FORECAST, METRICS, VALUE
from panelcast.session import scratch_path
from panelcast.sources import feature_table, models, results

HOURS = 24 * 20


def wave(h, scale):
    return scale * (20 + 8 * math.sin(2 * math.pi * h / 24) + 3 * math.cos(2 * math.pi * h / 168) + (h * 7919 % 13) / 7)


@pytest.fixture(scope="module")
def panel(spark):
    from tests.conftest import _hour
    from panelcast.schemas import PANEL
    rows = [
        (_hour(h), a, c, wave(h, 1 + a + c % 10))
        for a, c in ((0, 111), (1, 111), (1, 112)) for h in range(HOURS)
    ]
    return spark.createDataFrame(rows, PANEL).cache()


@pytest.fixture(scope="module")
def model(panel):
    return fc.fit(panel)


def features(past, hour, area, kind):
    lags = [past[-k] for k in range(1, 73)]
    means = [np.mean(past[-n:]) for n in (24, 48, 72)]
    stds = [np.std(past[-n:], ddof=1) for n in (24, 48, 72)]
    return np.array([*lags, *means, *stds, (hour // 24) % 7, hour % 24, area, kind])


def by_hand(model, area, kind, horizon, start=HOURS):
    learner = model.stages[-1]
    past = [wave(h, 1 + area + kind % 10) for h in range(start - 72, start)]
    for h in range(start, start + horizon):
        past.append(learner.coefficients.toArray() @ features(past, h, area, kind) + learner.intercept)
    return past[72:]


def test_training_rows_match_features_by_hand(panel):
    from pyspark.ml.functions import vector_to_array
    row = (
        fc.features_of(panel).filter("area = 1 and consumer_type = 112").orderBy("datetime_utc")
        .select(vector_to_array("features").alias("x")).first()
    )
    past = [wave(h, 1 + 1 + 2) for h in range(72)]
    assert np.allclose(row["x"], features(past, 72, 1, 112))
    assert fc.features_of(panel).count() == 3 * (HOURS - 72)


def test_fit_solves_the_normal_equations(panel, model):
    residual = fc.features_of(panel)
    scored = model.stages[-1].transform(residual)
    assert scored.agg(F.avg(F.abs(F.col("prediction") - F.col(VALUE)) / F.col(VALUE))).first()[0] < 0.1


def test_recursion_matches_a_loop(panel, model, hour):
    got = {
        (r["area"], r["consumer_type"], r["datetime_utc"]): r[VALUE] for r in fc.forecast(model, panel, 30).collect()
    }
    assert len(got) == 3 * 30
    for area, kind in ((0, 111), (1, 112)):
        want = by_hand(model, area, kind, 30)
        assert np.allclose([got[area, kind, hour(HOURS + i)] for i in range(30)], want, rtol=1e-8)


def test_unseen_series_get_null(spark, panel, model):
    asked = spark.createDataFrame([(0, 111), (0, 112)], "area tinyint, consumer_type int")
    got = fc.forecast(model, panel, 24, asked)
    assert got.count() == 48
    assert got.filter("consumer_type = 112 and energy_consumption is null").count() == 24
    assert got.filter("consumer_type = 111 and energy_consumption is null").count() == 0


@pytest.mark.parametrize("fill, want", [("zero", [1.0, 0.0, 3.0, 0.0]), ("last", [1.0, 1.0, 3.0, 3.0]), (None, [1.0, None, 3.0, None])])
def test_history_fill(make_panel, fill, want):
    df = make_panel({(0, 111): [(0, 9.0), (1, 1.0), (3, 3.0)], (1, 111): [(4, 1.0)]})
    row = fc.latest_history(df, 4, fill=fill).filter("area = 0").first()
    assert row["history"] == want


def test_tree_recursion_matches_a_loop(panel, hour):
    trees = fc.fit(panel, {"learner": "trees", "n_estimators": 3, "max_depth": 3})
    got = {r["datetime_utc"]: r[VALUE] for r in fc.forecast(trees, panel, 10).filter("area = 1 and consumer_type = 111").collect()}
    from pyspark.ml.linalg import Vectors
    past = [wave(h, 1 + 1 + 1) for h in range(HOURS - 72, HOURS)]
    for h in range(HOURS, HOURS + 10):
        past.append(trees.stages[-1].predict(Vectors.dense(features(past, h, 1, 111))))
    assert np.allclose([got[hour(HOURS + i)] for i in range(10)], past[72:])


def test_flat_trees_equal_the_library_and_its_steps(spark, panel):
    model = fc.fit(panel, {"learner": "trees", "n_estimators": 70, "max_depth": 4})
    learner, trees = model.stages[-1], FlatTrees.of_model(spark, model.stages[-1])
    rows = fc.features_of(panel).limit(200)
    want = [r["prediction"] for r in learner.transform(rows).collect()]
    x = np.array([r["features"].toArray() for r in learner.transform(rows).collect()])
    assert np.allclose(trees.predict(x), want) and len(trees.roots) == 70 and trees.predict(x[:0]).shape == (0,)
    settings, others = fc.window_settings(model), fc.others_of(model)
    state = fc.latest_history(panel, 72).union(fc.latest_history(panel, 72).limit(1).withColumn("area", F.lit(2).cast("tinyint")).withColumn("history", F.lit(None)))
    one, steps = (as_map(f(state, m, settings, 24, others)) for f, m in ((fc.flat_tree_forecast, trees), (fc.stepwise_forecast, learner)))
    assert set(one) == set(steps) and all(np.allclose(one[k], steps[k]) for k in one if steps[k] is not None)
    missing = [k for k in steps if steps[k] is None]
    assert len(missing) == 1 and all(v is None for v in one[missing[0]])
    assert fc.as_rows(fc.flat_tree_forecast(state, trees, settings, 24, others)).where("energy_consumption is null").count() == 24
    plan = fc.flat_tree_forecast(state, trees, settings, 24, others)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") <= 2  # one for each side of the union


def as_map(df):
    return {(r["area"], r["consumer_type"]): r["forecast"] for r in df.collect()}


def test_cross_validation_forecasts_from_each_cut(panel):
    got = fc.cross_validate(panel, fc.grid_configs({"reg_lambda": [0.0, 0.5]}), 24, 3)
    found = {(r["config_id"], r["fold"]): r["MAPE"] for r in got.collect()}
    cuts = [136, 296, 456]
    assert sorted(found) == [(c, f) for c in (0, 1) for f in range(len(cuts))]
    # Fold 1 by hand: fit on the hours before the cut, forecast the day after it.
    from panelcast.operators.windows import between_hours
    from tests.conftest import _hour
    train = between_hours(panel, _hour(0), _hour(cuts[1]))
    fitted = fc.fit(train, {"std": fc.GRID_STD_WINDOWS})
    test = between_hours(panel, _hour(cuts[1]), _hour(cuts[1] + 24))
    want = score(fc.evaluate(fitted, train, test)).first()["MAPE"]
    assert found[0, 1] == pytest.approx(want, rel=1e-6, abs=1e-9)


def test_search_publishes_a_config(spark, panel):
    root = scratch_path(spark, "best")
    with pytest.raises(FileNotFoundError):
        training.read_best(spark, root)
    best = training.search(panel, {"reg_lambda": [0.0, 0.5], "lag": [(24,), (1, 24)], "mean": [()]})
    training.publish_best(best, root)
    config = training.published_config(spark, root)
    assert config["config_id"] == best.first()["config_id"] and config["reg_lambda"] in (1e-6, 0.5) and config["lag"] in ([24], [1, 24])
    assert training.train_and_register(spark, panel, root) == 1  # the published configuration, whole
    from pyspark.sql.types import StructType
    record = results.latest_run(spark, root, "training", StructType.fromDDL(training.TRAINING_RUN)).first()
    assert record["version"] == 1 and json.loads(record["config"])["lag"] == config["lag"]
    assert {s["split"] for s in json.loads(record["splits"])} == {"train", "test"}
    assert {e["model"] for e in json.loads(record["errors"])} == {"baseline", "model"} and len(json.loads(record["worst_slices"])) == 3


def test_tree_trials_honour_their_settings(panel):
    grid = fc.grid_configs({"learner": ["trees"], "n_estimators": [1, 4], "max_depth": [-1, 2], "lag": [(24,)], "mean": [()], "std": [()]})
    got = {(r["config_id"], r["fold"]): r for r in fc.cross_validate(panel, [{**c, "deepest": 3} for c in grid], 3, 3).collect()}
    assert len({got[c, 1]["MAPE"] for c in range(4)}) == 4
    assert json.loads(got[0, 0]["config"])["max_depth"] == 3 and json.loads(got[1, 0]["config"])["max_depth"] == 2
    from panelcast.operators.timeseries import label_folds
    folds = label_folds(panel, 3, 3).filter("fold = 1")
    train, test = (folds.filter(F.col("split") == part).select(*panel.columns) for part in ("train", "test"))
    fitted = fc.fit(train, grid[1])
    assert got[1, 1]["MAPE"] == pytest.approx(score(fc.evaluate(fitted, train, test, 3)).first()["MAPE"], rel=1e-6)


def test_unknown_settings_are_refused():
    with pytest.raises(ValueError, match="num_trees"):
        fc.build_forecaster({"num_trees": 5})


def test_grid_numbering_agrees(spark):
    rows = fc.expand_grid(spark.range(1)).drop("id").collect()
    assert len(rows) == 36
    assert {r["config_id"]: (r["n_estimators"], r["reg_lambda"]) for r in rows} == {
        c["config_id"]: (c["n_estimators"], c["reg_lambda"]) for c in fc.grid_configs()
    }


def test_model_versions(spark, panel, model):
    root = scratch_path(spark, "models")
    train, test = training.split(panel)
    scores = score(training.baseline_pairs(train, test))
    assert [models.register_model(spark, model, scores, root, "m") for _ in range(2)] == [1, 2]
    loaded = models.load_model(spark, root, "m")
    a, b = (fc.forecast(m, panel).orderBy("area", "consumer_type", "datetime_utc").collect() for m in (model, loaded))
    assert a == b
    assert models.model_versions(spark, root).count() == 2
    with pytest.raises(LookupError):
        models.load_model(spark, root, "m", 7)


def test_prediction_then_monitoring(spark, panel, hour):
    root, table = scratch_path(spark, "run"), scratch_path(spark, "table")
    assert monitoring.run_monitoring(spark, table, root) == "no forecasts"
    known = panel.filter(F.col("datetime_utc") < F.lit(str(hour(HOURS - 24))).cast("timestamp_ntz"))
    feature_table.upsert(spark, table, known)
    training.train_and_register(spark, known, f"{root}/models", {})
    predictions = prediction.run_prediction(spark, table, f"{root}/models", root, hour(0), hour(HOURS))
    # Four key pairs, one never observed: published as NULL, not cached.
    assert predictions.count() == 4 * 24 and predictions.filter(f"{VALUE} is null").count() == 24
    cache = results.read_published(spark, root, "predictions_monitoring", FORECAST)
    assert cache.count() == 3 * 24
    assert monitoring.run_monitoring(spark, table, root) == "no observations"
    feature_table.upsert(spark, table, panel)
    assert monitoring.run_monitoring(spark, table, root) == "published"
    metrics = monitoring.published_metrics(spark, root)
    # The read is closed at the last forecast hour, so all 24 hours are scored.
    assert metrics.schema == METRICS and metrics.count() == 24
    page = pages.series_pages(panel, predictions).filter("area = 0 and consumer_type = 111").first()
    assert len(page["datetime_utc"]) == 168 and len(page["preds_datetime_utc"]) == 24
    both = pages.comparison_pages(monitoring.published_truth(spark, root), cache)
    assert both.count() == 3


def test_cache_keeps_first_forecast_and_floor(spark, make_panel, hour):
    cached = make_panel({(0, 111): [(0, 1.0), (5, 5.0)]}).select(*FORECAST.names)
    new = make_panel({(0, 111): [(5, 6.0), (6, 7.0), (7, None)]}).select(*FORECAST.names)
    got = {r["datetime_utc"]: r[VALUE] for r in prediction.merge_into_cache(new, cached, hour(2)).collect()}
    assert got == {hour(5): 5.0, hour(6): 7.0}


def test_series_without_either_side_have_no_page(make_panel):
    truth = make_panel({(0, 111): [(0, 1.0)], (1, 111): [(0, 1.0)]})
    forecasts = make_panel({(0, 111): [(0, 1.0), (1, 2.0)], (2, 111): [(0, 1.0)]})
    row, = pages.comparison_pages(truth, forecasts).collect()
    assert row["area"] == 0 and row["predictions_monitoring_energy_consumption"] == [1.0, 2.0]


def test_user_metric_and_forecaster(spark, panel):
    df = spark.createDataFrame([(10.0, 9.0), (20.0, 22.0)], "y double, p double")
    error = hooks.pointwise(lambda y, p: (y - p).abs() / y.abs())
    assert df.agg(F.avg(error)).first()[0] == pytest.approx(0.1)
    last = hooks.forecast_each(panel, lambda rows: rows.tail(1), history_hours=5)
    assert last.count() == 3


def test_user_aggregates_merge_and_split_a_hot_group(spark):
    rows = [("hot" if i % 3 else f"k{i % 7}", float((i * 37) % 101 - 50), float(i % 5)) for i in range(3000)] + [(None, 2.0, 1.0), ("nulls", None, 1.0)]
    df = spark.createDataFrame(rows, "k string, y double, p double").repartition(9)
    error = lambda r: (r["y"] - r["p"]).abs()
    got = {r["k"]: r["value"] for r in hooks.aggregate_by(df, ["k"], hooks.GroupMean(error), ["y", "p"], fan_in=2).collect()}
    groups = {}
    for k, y, p in rows:
        groups.setdefault(k, []).append((y, p))
    assert set(got) == set(groups) and got["nulls"] is None
    for k, pairs in groups.items():
        if k != "nulls":
            assert got[k] == pytest.approx(sum(abs(y - p) for y, p in pairs) / len(pairs))
    for q in (0.0, 0.5, 0.9, 1.0):
        quantile = hooks.GroupQuantile("y", q, 0.01)
        got = {r["k"]: r["value"] for r in hooks.aggregate_by(df, ["k"], quantile, ["y"]).collect()}
        for k, pairs in groups.items():
            values = sorted(y for y, _ in pairs if y is not None)
            assert got[k] == (pytest.approx(values[int(q * (len(values) - 1))], rel=0.0101) if values else None)
    assert hooks.aggregate_by(df.limit(0), ["k"], hooks.GroupMean(error), ["y", "p"]).count() == 0


def test_zero_and_negative_observations_are_scored(make_panel):
    rows = {(0, 111): [(h, 5.0 if h < 48 else (5.0, 0.0, -3.0)[h % 3]) for h in range(72)]}
    train, test = training.split(make_panel(rows))
    assert training.baseline_pairs(train, test).count() == 24
    trials = training.season_trials(make_panel({(0, 111): [(h, float(h % 5 - 2)) for h in range(24 * 30)]}), (24,))
    assert trials.count() == 3 and trials.where("MAPE is null").count() == 0


def test_filled_hours_are_not_scored(make_panel):
    sparse = make_panel({(0, 111): [(h, 5.0) for h in range(72) if h != 60]})
    train, test = training.split(joins.fill_hours(sparse, fill=0.0, observed="observed"))
    assert training.baseline_pairs(train, test).count() == 23
