"""Pooled forecasting: one regressor for all series, recursive forecasts, parameter search."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from itertools import product
from multiprocessing.pool import ThreadPool
from time import perf_counter

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from panelcast.functions.hours import (
    add_hours, day_of_week, epoch_hour, from_epoch_hour, hour_of_day,
)
from panelcast.operators.aggregates import mean_over_folds, score
from panelcast.operators.clean import AttachKeys
from panelcast.operators.features import (
    CALENDAR, KEY_FEATURES, CalendarFeatures, FeatureVector, WindowFeatures, depth_of, feature_vector,
    other_features, vector_size, window_values,
)
from panelcast.operators.joins import pair
from panelcast.operators.normal_equations import Moments, moments
from panelcast.operators.trees import FlatTrees
from panelcast.operators.timeseries import LAGS, MEAN_WINDOWS, STD_WINDOWS, fold_bounds
from panelcast.schemas import HORIZON, KEYS, OBSERVED, TIME, VALUE
from panelcast.session import ensure_checkpoints

# The searched parameter lists.
GRID = {
    "n_estimators": [1000, 2000, 2500],
    "learning_rate": [0.1, 0.15],
    "max_depth": [-1, 5],
    "reg_lambda": [0.0, 0.01, 0.015],
}
GRID_STD_WINDOWS = ((1, 24), (1, 48))

# Parts of a linear model's weights, as used by the recursion.
WEIGHTS = ("lag", "std", "calendar", "key", "intercept")

# Rolling means are sums of lags, so without a penalty the normal equations of the linear learner
# are singular and Spark falls back to an iterative, inexact solution. This ridge avoids that.
SMALLEST_RIDGE = 1e-6

# Spark's boosted trees have a depth limit; this stands for "unlimited".
DEEPEST_TREE = 8
# Recursion rounds of a tree model between two reliable checkpoints.
ROUNDS_PER_CHECKPOINT = 8


# --- model ------------------------------------------------------------------------------------

# Names a configuration may have.
SETTINGS = frozenset({
    "config_id", "lag", "mean", "std", "calendar", "keys", "learner", "reg_lambda", "smallest_ridge",
    "n_estimators", "learning_rate", "max_depth", "deepest", "seed", "fill",
})


def checked(config: dict | None) -> dict:
    """A configuration without names that would be ignored."""
    unknown = set(config or {}) - SETTINGS
    if unknown:
        raise ValueError(f"unknown settings {sorted(unknown)}")
    return dict(config or {})


def effective(config: dict) -> dict:
    """What the learner really gets: the ridge or depth that stands for "none" is stated here."""
    if config.get("learner", "linear") == "linear":
        return {"reg_lambda": max(float(config.get("reg_lambda", 0.0)), float(config.get("smallest_ridge", SMALLEST_RIDGE)))}
    depth = int(config.get("max_depth", -1))
    return {
        "n_estimators": int(config.get("n_estimators", 20)), "learning_rate": float(config.get("learning_rate", 0.1)),
        "max_depth": depth if depth > 0 else int(config.get("deepest", DEEPEST_TREE)),
    }


def regressor(config: dict):
    """The learner of a configuration: ``linear`` (default) or ``trees``."""
    columns = {"featuresCol": "features", "labelCol": VALUE, "predictionCol": "prediction"}
    learner, used = checked(config).get("learner", "linear"), effective(config)
    if learner == "linear":
        return LinearRegression(regParam=used["reg_lambda"], solver="normal", **columns)
    if learner != "trees":
        raise ValueError(f"unknown learner {learner!r}")
    return GBTRegressor(
        maxIter=used["n_estimators"], stepSize=used["learning_rate"], maxDepth=used["max_depth"],
        seed=int(config.get("seed", 7)), **columns,
    )


def feature_settings(config: dict) -> tuple[list, list, list]:
    """(lags, means, stds) of a configuration."""
    windows = config.get("lag", LAGS), config.get("mean", MEAN_WINDOWS), config.get("std", STD_WINDOWS)
    return list(windows[0]), [list(w) for w in windows[1]], [list(w) for w in windows[2]]


def build_forecaster(config: dict | None = None) -> Pipeline:
    """Keys as features, calendar, look-back windows, vector, pooled regressor."""
    config = checked(config)
    lags, means, stds = feature_settings(config)
    others = other_features(config)
    vector = FeatureVector(size=vector_size(lags, means, stds, others), others=others)
    return Pipeline(stages=[AttachKeys(), CalendarFeatures(), WindowFeatures(lags=lags, means=means, stds=stds), vector, regressor(config)])


def features_of(panel: DataFrame, config: dict | None = None) -> DataFrame:
    """The training rows that the forecaster's feature stages produce."""
    for stage in build_forecaster(config).getStages()[:-1]:
        panel = stage.transform(panel)
    return panel


def fit(train: DataFrame, config: dict | None = None) -> PipelineModel:
    """Fit one model over all series of an hourly panel.

    The learner reads its input more than once, so the panel (about 30 bytes a row) is kept for the
    time of the fit; the features, some 700 bytes a row, are made anew in each pass.
    """
    panel = train.select(*KEYS, TIME, VALUE).persist()
    try:
        return build_forecaster(config).fit(panel)
    finally:
        panel.unpersist()


@dataclass(frozen=True)
class LinearForecaster:
    """A pooled linear model given by its numbers: solved from normal equations, or set by hand.

    It forecasts and is evaluated like a fitted pipeline. Coefficients are in the order of the feature vector.
    """

    coefficients: tuple[float, ...]
    intercept: float
    config: dict = field(default_factory=dict)


@dataclass(frozen=True)
class TreeForecaster:
    """Pooled boosted trees as flat arrays, used like a fitted pipeline; features are those of the configuration, in order."""

    trees: FlatTrees
    config: dict = field(default_factory=dict)


def design(panel: DataFrame, settings, others, keys=KEYS, time: str = TIME, value: str = VALUE) -> DataFrame:
    """Time, value and the feature array ``x`` of every row with a full history."""
    lags, means, stds = settings
    ready = WindowFeatures(lags=lags, means=means, stds=stds).transform(CalendarFeatures().transform(AttachKeys().transform(panel)))
    x = F.concat("window", F.array(*[F.col(c).cast("double") for c in others])) if others else F.col("window")
    return ready.select(*keys, time, value, x.alias("x"))


def moments_of(panel: DataFrame, config: dict | None = None) -> Moments:
    """Second moments of all features and the value over the training rows of a panel."""
    settings, others = feature_settings(config or {}), other_features(config or {})
    width = vector_size(*settings, others) + 1
    rows = design(panel, settings, others).withColumn("_all", F.lit(0))
    return moments(rows, "_all", "x", VALUE, width).get(0, Moments.none(width))


def solve(train: DataFrame, config: dict | None = None) -> LinearForecaster:
    """The linear model of a configuration in one pass over the panel; nothing is kept between passes."""
    config = checked(config)
    coefficients, intercept = moments_of(train, config).ridge(effective(config)["reg_lambda"])
    return LinearForecaster(tuple(map(float, coefficients)), intercept, config)


def window_settings(model) -> tuple[list, list, list]:
    if isinstance(model, (LinearForecaster, TreeForecaster)):
        return feature_settings(model.config)
    return next(s for s in model.stages if isinstance(s, WindowFeatures)).settings()


def others_of(model) -> list[str]:
    if isinstance(model, (LinearForecaster, TreeForecaster)):
        return other_features(model.config)
    stage = next(s for s in model.stages if isinstance(s, FeatureVector))
    return list(stage.getOrDefault("others"))


# --- history ----------------------------------------------------------------------------------

def latest_history(
    df: DataFrame, length: int = 72, keys=KEYS, time: str = TIME, value: str = VALUE,
    fill: str | None = "zero", as_of: Column | None = None,
) -> DataFrame:
    """One row per series with its ``length`` hours up to ``as_of``, oldest first, and that hour as ``last``.

    ``as_of`` defaults to the latest hour of the whole table, so series that stopped earlier get
    missing hours. ``fill``: ``zero`` and ``last`` replace them, None leaves NULL. Rows outside the
    range are filtered before the shuffle, which leaves at most ``length`` values per series.
    """
    last = as_of if as_of is not None else df.agg(F.max(time)).scalar()
    recent = df.filter((F.col(time) > add_hours(last, -length)) & (F.col(time) <= last))
    listed = recent.groupBy(*keys).agg(_listed(time, value))
    return listed.withColumn("last", last).transform(_as_history, length, keys, fill)


def fold_histories(
    df: DataFrame, folds: DataFrame, length: int = 72, keys=KEYS, time: str = TIME, value: str = VALUE,
    fill: str | None = "zero",
) -> DataFrame:
    """``latest_history`` at the end of training of every fold, from one pass over the table."""
    ends = folds.select("fold", F.timestamp_add("HOUR", (F.col("train_end") - 1).cast("int"), F.col("origin")).alias("last"))
    cuts = ends.agg(F.collect_list(F.struct("fold", "last"))).scalar()
    return (
        df.withColumn("_cut", F.explode(cuts))
        .select(*keys, time, value, F.col("_cut.fold").alias("fold"), F.col("_cut.last").alias("last"))
        .filter((F.col(time) > add_hours("last", -length)) & (F.col(time) <= F.col("last")))
        .groupBy("fold", "last", *keys).agg(_listed(time, value))
        .transform(_as_history, length, ("fold", *keys), fill)
    )


def _listed(time: str, value: str) -> Column:
    entries = F.collect_list(F.struct(epoch_hour(time).alias("h"), F.col(value).alias("v")))
    return F.map_from_entries(entries).alias("_values")


def _as_history(listed: DataFrame, length: int, keys, fill: str | None) -> DataFrame:
    end = epoch_hour("last")
    hours = F.sequence(end - (length - 1), end)
    values = F.col("_values")
    if fill == "zero":
        past = F.transform(hours, lambda h: F.coalesce(F.try_element_at(values, h), F.lit(0.0)))
    elif fill == "last":
        past = F.aggregate(
            hours, F.array().cast("array<double>"),
            lambda acc, h: F.concat(acc, F.array(F.coalesce(F.try_element_at(values, h), F.try_element_at(acc, F.lit(-1))))),
        )
    elif fill is None:
        past = F.transform(hours, lambda h: F.try_element_at(values, h))
    else:
        raise ValueError(f"fill must be 'zero', 'last' or None, not {fill!r}")
    return listed.select(*keys, "last", past.alias("history"))


# --- recursive forecast -----------------------------------------------------------------------

def linear_weights(coefficients, intercept: float, settings, others=(*CALENDAR, *KEY_FEATURES)) -> dict:
    """Coefficients of a fitted linear model, arranged for the recursion.

    A rolling mean is itself a weighted sum of lags, so its coefficient is spread over the lags and
    a step needs one dot product. Lag weights are ordered oldest first, like the history.
    """
    lags, means, stds = settings
    depth = depth_of(*settings)
    values = [float(c) for c in coefficients]
    lag_part, rest = values[: len(lags)], values[len(lags):]
    by_lag = [0.0] * (depth + 1)
    for k, weight in zip(lags, lag_part):
        by_lag[k] += weight
    for (shift, length), weight in zip(means, rest):
        for k in range(shift, shift + length):
            by_lag[k] += weight / length
    rest = rest[len(means):]
    given = dict(zip(others, rest[len(stds):]))
    return {
        "lag": by_lag[:0:-1], "std": rest[: len(stds)], "calendar": [given.get(c, 0.0) for c in CALENDAR],
        "key": [given.get(c, 0.0) for c in KEY_FEATURES], "intercept": float(intercept),
    }


def weights_of(model) -> dict:
    fitted = model if isinstance(model, LinearForecaster) else model.stages[-1]
    return linear_weights(fitted.coefficients, fitted.intercept, window_settings(model), others_of(model))


def literal_weights(weights: dict) -> dict[str, Column]:
    def constant(weight) -> Column:
        if isinstance(weight, float):
            return F.lit(weight)
        return F.expr(f"cast(array({', '.join(f'{x!r}D' for x in weight)}) as array<double>)")

    return {name: constant(weight) for name, weight in weights.items()}


def _recursion(stds, horizon: int):
    """Batch function of the recursion: all series of an Arrow batch advance together, hour by hour."""
    def run(
        past: pd.Series, hour: pd.Series, fixed: pd.Series, lag: pd.Series, std: pd.Series, calendar: pd.Series,
    ) -> pd.Series:
        depth = len(lag.iloc[0])
        values = np.full((len(past), depth + horizon), np.nan)
        values[:, :depth] = [np.full(depth, np.nan) if p is None else p for p in past]
        by_lag, by_std, by_calendar = (np.stack(list(w)) for w in (lag, std, calendar))
        for step in range(horizon):
            at = hour.to_numpy() + step + 1
            # The epoch began on a Thursday, day 3 of a week that starts on Monday.
            clock = np.column_stack([(at // 24 + 3) % 7, at % 24])
            result = fixed.to_numpy() + (values[:, step:step + depth] * by_lag).sum(axis=1)
            result = result + (clock * by_calendar).sum(axis=1)
            for i, (shift, length) in enumerate(stds):
                end = depth + step - shift + 1
                result = result + by_std[:, i] * values[:, end - length:end].std(axis=1, ddof=1)
            values[:, depth + step] = result
        return pd.Series(list(values[:, depth:]))

    return F.pandas_udf(run, "array<double>")


def linear_forecast(
    state: DataFrame, weights: dict[str, Column], stds=STD_WINDOWS, horizon: int = HORIZON, keys=KEYS,
) -> DataFrame:
    """Add ``forecast``: the ``horizon`` predicted values, each fed back as history for the next.

    ``state`` has one row per series (keys, ``last``, ``history``); the weights are literals or
    columns of ``state``. The recursion is one narrow projection over Arrow batches of series: no
    shuffle and no driver loop. Written with nested array functions, which Spark interprets value by
    value, the same steps took ten times as long (5 s against 0.5 s for 5,508 series).
    """
    fixed = weights["intercept"]
    for i, key in enumerate(keys):
        fixed = fixed + weights["key"][i] * F.col(key)
    run = _recursion([tuple(w) for w in stds], horizon)
    values = run("history", epoch_hour("last"), fixed, weights["lag"], weights["std"], weights["calendar"])
    return state.withColumn("forecast", values)


def forecast_with(
    state: DataFrame, model: DataFrame, stds=STD_WINDOWS, horizon: int = HORIZON, keys=KEYS,
) -> DataFrame:
    """``linear_forecast`` with weights from a one-row table, read as a scalar."""
    packed = model.select(F.struct(*WEIGHTS).alias("weights")).scalar()
    held = state.withColumn("_weights", packed)
    weights = {name: F.col(f"_weights.{name}") for name in WEIGHTS}
    return linear_forecast(held, weights, stds, horizon, keys).drop("_weights")


def _tree_recursion(trees: FlatTrees, settings, others, horizon: int):
    """Batch function of the recursion of trees: all series of an Arrow batch advance together, hour by hour."""
    lags, means, stds = settings
    depth = depth_of(*settings)

    def run(past: pd.Series, hour: pd.Series, keys: pd.DataFrame) -> pd.Series:
        values = np.full((len(past), depth + horizon), np.nan)
        values[:, :depth] = [np.full(depth, np.nan) if p is None else p for p in past]
        known = ~np.isnan(values[:, :depth]).any(axis=1)
        fixed = {name: keys[name].to_numpy(float) for name in keys.columns}
        for step in range(horizon):
            end, at = depth + step, hour.to_numpy() + step + 1
            # The epoch began on a Thursday, day 3 of a week that starts on Monday.
            given = {CALENDAR[0]: (at // 24 + 3) % 7, CALENDAR[1]: at % 24, **fixed}
            columns = [values[:, end - k] for k in lags]
            columns += [values[:, end - s - n + 1:end - s + 1].mean(axis=1) for s, n in means]
            columns += [values[:, end - s - n + 1:end - s + 1].std(axis=1, ddof=1) for s, n in stds]
            columns += [given[name] for name in others]
            values[:, end] = np.where(known, trees.predict(np.column_stack(columns)), np.nan)
        return pd.Series(list(values[:, depth:]))

    run.__annotations__ = {"past": pd.Series, "hour": pd.Series, "keys": pd.DataFrame, "return": pd.Series}
    return F.pandas_udf(run, "array<double>")


def flat_tree_forecast(
    state: DataFrame, trees: FlatTrees, settings, horizon: int = HORIZON, others=(*CALENDAR, *KEY_FEATURES),
) -> DataFrame:
    """``linear_forecast`` for boosted trees: one narrow projection, no shuffle, no checkpoint and no loop on the driver."""
    run = _tree_recursion(trees, settings, tuple(others), horizon)
    keys = F.struct(*[F.col(k).cast("double").alias(f) for k, f in zip(KEYS, KEY_FEATURES)])
    return state.withColumn("forecast", run("history", epoch_hour("last"), keys))


def tree_forecast(
    state: DataFrame, learner, settings, horizon: int = HORIZON, others=(*CALENDAR, *KEY_FEATURES),
) -> DataFrame:
    """``linear_forecast`` for any Spark ML regressor; boosted trees in one pass, others by one transform per step."""
    spark = state.sparkSession
    if isinstance(learner, GBTRegressionModel):
        return flat_tree_forecast(state, FlatTrees.of_model(spark, learner), settings, horizon, others)
    return stepwise_forecast(state, learner, settings, horizon, others)


def stepwise_forecast(
    state: DataFrame, learner, settings, horizon: int = HORIZON, others=(*CALENDAR, *KEY_FEATURES),
) -> DataFrame:
    """The recursion for regressors known only by their ``transform``: one of the series table per step.

    The history travels in the row, so a step shuffles nothing. Reliable checkpoints keep the plan
    short.
    """
    if horizon > ROUNDS_PER_CHECKPOINT:
        ensure_checkpoints(state.sparkSession)
    # Filtered once, before the recursion: a later filter would pull every step's prediction into it.
    known = F.col("history").isNotNull() & ~F.exists("history", lambda x: x.isNull())
    grown = AttachKeys().transform(state.filter(known))
    window = window_values(F.col("history"), *settings)
    for step in range(1, horizon + 1):
        at = add_hours("last", step)
        ready = grown.withColumns({
            "window": window,
            CALENDAR[0]: day_of_week(at), CALENDAR[1]: hour_of_day(at),
        }).withColumn("features", feature_vector(others))
        grown = (
            learner.transform(ready)
            .withColumn("history", F.concat("history", F.array("prediction")))
            .select(*state.columns, *KEY_FEATURES)
        )
        if step % ROUNDS_PER_CHECKPOINT == 0 and step < horizon:
            grown = grown.checkpoint()
    done = grown.select(*KEYS, F.slice("history", -horizon, horizon).alias("forecast"))
    return state.join(done, list(KEYS), "left")


def as_rows(forecasts: DataFrame, horizon: int = HORIZON, keys=KEYS, time: str = TIME, value: str = VALUE) -> DataFrame:
    """Arrays of forecasts as one row per hour; a series without a forecast gets NULL values."""
    none = F.lit(None).cast("double")
    listed = F.coalesce("forecast", F.array_repeat(none, horizon))
    return (
        forecasts.select(*keys, "last", F.posexplode(listed).alias("_pos", value))
        .select(*keys, add_hours("last", F.col("_pos") + 1).alias(time), F.nanvl(value, none).alias(value))
    )


def forecast(
    model: PipelineModel | LinearForecaster | TreeForecaster, panel: DataFrame, horizon: int = HORIZON, series: DataFrame | None = None,
    fill: str | None = "zero",
) -> DataFrame:
    """Forecast the ``horizon`` hours after the latest hour of the panel.

    ``series`` names the series wanted (default: those of the panel); one without history gets NULL.
    """
    settings = window_settings(model)
    state = latest_history(panel, depth_of(*settings), fill=fill)
    if series is not None:
        state = series.join(state.drop("last"), list(KEYS), "left").withColumn(
            "last", panel.agg(F.max(TIME)).scalar()
        )
    if isinstance(model, TreeForecaster):
        done = flat_tree_forecast(state, model.trees, settings, horizon, others_of(model))
    elif isinstance(model, LinearForecaster) or isinstance(model.stages[-1], _linear_model_type()):
        done = linear_forecast(state, literal_weights(weights_of(model)), settings[2], horizon)
    else:
        done = tree_forecast(state, model.stages[-1], settings, horizon, others_of(model))
    return as_rows(done, horizon)


def _linear_model_type():
    from pyspark.ml.regression import LinearRegressionModel
    return LinearRegressionModel


def evaluate(model: PipelineModel | LinearForecaster | TreeForecaster, train: DataFrame, test: DataFrame, horizon: int = HORIZON,
             fill: str | None = "zero") -> DataFrame:
    """(actual, forecast) pairs of the test hours that have an observation, whatever its value."""
    return pair(observed(test), forecast(model, train, horizon, fill=fill))


def observed(df: DataFrame, value: str = VALUE, flag: str = OBSERVED) -> DataFrame:
    """Rows with an observation: those that a gap-filled panel flags as such, or all with a value."""
    return df.filter(F.col(flag)) if flag in df.columns else df.filter(F.col(value).isNotNull())


# --- AR(lag) closed form ----------------------------------------------------------------------

def lag_regression(lagged: DataFrame, lag_column: str, value: str = VALUE) -> DataFrame:
    """Slope and intercept of the pooled regression of the value on one lag."""
    return lagged.filter(F.col(lag_column).isNotNull()).agg(
        F.regr_slope(value, lag_column).alias("slope"), F.regr_intercept(value, lag_column).alias("intercept"),
        F.regr_count(value, lag_column).alias("n"),
    )


# --- parameter search -------------------------------------------------------------------------

def grid_configs(parameters: dict[str, list] = GRID) -> list[dict]:
    """All combinations, numbered in the order of the lists."""
    combos = product(*parameters.values())
    return [{"config_id": i, **dict(zip(parameters, c))} for i, c in enumerate(combos)]


def expand_grid(df: DataFrame, parameters: dict[str, list] = GRID) -> DataFrame:
    """Every row of ``df`` with every combination of the parameter lists and its ``config_id``."""
    config_id = F.lit(0)
    for name, values in parameters.items():
        listed = F.array(*[F.lit(v) for v in values])
        df = df.select("*", F.posexplode(listed).alias(f"_pos_{name}", name))
        config_id = config_id * len(values) + F.col(f"_pos_{name}")
    return df.withColumn("config_id", config_id).drop(*[f"_pos_{n}" for n in parameters])


def trial_plan(labelled: DataFrame, parameters: dict[str, list] = GRID) -> DataFrame:
    """One row per (config, fold) with the rows the trial trains and tests on."""
    sizes = labelled.groupBy("fold").agg(
        F.count_if(F.col("split") == "train").alias("train_rows"),
        F.count_if(F.col("split") == "test").alias("test_rows"),
    )
    return expand_grid(sizes, parameters)


FOLD_WEIGHTS = "config_id int, fold int, lag array<double>, std array<double>, calendar array<double>, " \
    "key array<double>, intercept double"
FOLD_RESULTS = "config_id int, fold int, config string, MAPE double, fit_time double, prediction_time double"


def cross_validate(
    panel: DataFrame, configs: list[dict], horizon: int = HORIZON, k: int = 3, parallel_trials: int = 4,
    std=GRID_STD_WINDOWS, keep_features: bool = True, solved: dict | None = None,
) -> DataFrame:
    """Fold results (config_id, fold, config, MAPE, fit_time, prediction_time) of all trials.

    Every setting of a configuration counts; ``config`` is the whole of it with what the learner really
    got, as JSON. All linear trials that look equally far back cost one pass over the panel, whatever their penalties,
    folds and features (``fold_moments``), and are forecast in a single plan. Tree trials with the same features
    share the feature rows, some 700 bytes each, which are kept, or with ``keep_features=False`` made anew by each
    trial, for training tables whose features do not fit the cluster's memory and local disks; each is a fit on the
    rows before its fold's cut, forecast by itself. A dictionary given as ``solved`` gets (coefficients, penalty, moments) of
    every linear trial by (config_id, fold).
    """
    spark = panel.sparkSession
    configs = [{"std": std, **checked(c)} for c in configs]
    folds = fold_bounds(panel, horizon, k)
    cuts = [(r["fold"], r["train_end"], r["origin"]) for r in folds.collect()]
    kept = panel.select(*KEYS, TIME, VALUE).persist()
    truth = observed(panel).select(*KEYS, TIME, F.col(VALUE).alias("y"))
    alike: dict[tuple, list[dict]] = {}
    for config in configs:  # linear trials share one pass if they look equally far back, trees if their features are the same
        linear = effective(config).keys() == {"reg_lambda"}
        same = depth_of(*feature_settings(config)) if linear else json.dumps([feature_settings(config), other_features(config)])
        alike.setdefault((linear, same), []).append(config)
    try:
        results = []
        for (linear, _), group in alike.items():
            if linear:
                results += _linear_trials(spark, kept, truth, folds, cuts, group, horizon, {} if solved is None else solved)
            else:
                results += _trials(spark, kept, truth, folds, cuts, group, horizon, parallel_trials, keep_features)
    finally:
        kept.unpersist()
    return spark.createDataFrame(sorted(results), FOLD_RESULTS)


def _union(lists) -> list:
    return list(dict.fromkeys(tuple(x) if isinstance(x, list) else x for one in lists for x in one))


def fold_moments(panel: DataFrame, cuts: list[tuple], settings, others) -> list[Moments]:
    """The state of the training rows of every fold, from one pass.

    Folds expand, so a row counts in the first fold that trains on it and in all later ones: each row goes to one segment
    between two cuts, and a fold's state is the merged states of the segments up to its cut.
    """
    ends = sorted((train_end, fold, origin) for fold, train_end, origin in cuts)
    segment = F.lit(None).cast("int")
    for i, (train_end, _, origin) in reversed(list(enumerate(ends))):
        cut = F.timestamp_add("HOUR", F.lit(train_end).cast("int"), F.lit(str(origin)).cast("timestamp_ntz"))
        segment = F.when(F.col(TIME) < cut, F.lit(i)).otherwise(segment)
    width = vector_size(*settings, others) + 1
    found = moments(design(panel, settings, others).withColumn("_segment", segment), "_segment", "x", VALUE, width)
    out, total = {}, Moments.none(width)
    for i, (_, fold, _) in enumerate(ends):
        total = total.merge(found.get(i, Moments.none(width)))
        out[fold] = total
    return [out[fold] for fold, _, _ in cuts]


def _linear_trials(spark, panel, truth, folds, cuts, configs: list[dict], horizon, out: dict) -> list[tuple]:
    """Linear trials that look equally far back: one pass for the equations of all, one plan for their forecasts.

    The pass has every feature that any trial has; a trial solves its rows and columns of the equations on the driver.
    """
    each = {c["config_id"]: (feature_settings(c), other_features(c)) for c in configs}
    settings = tuple(_union(s[i] for s, _ in each.values()) for i in range(3))
    others = _union(o for _, o in each.values())
    names = [*(("lag", k) for k in settings[0]), *(("mean", *w) for w in settings[1]), *(("std", *w) for w in settings[2]), *others]
    place = {name: i for i, name in enumerate(names)}
    began = perf_counter()
    states = fold_moments(panel, cuts, settings, others)
    passed = (perf_counter() - began) / (len(configs) * len(cuts))
    lines, fit_times = [], {}
    for config in configs:
        (lags, means, stds), own = each[config["config_id"]]
        columns = [place[n] for n in (*(("lag", k) for k in lags), *(("mean", *w) for w in means), *(("std", *w) for w in stds), *own)]
        for (fold, _, _), state in zip(cuts, states):
            began = perf_counter()
            own_state, penalty = state.only(columns), effective(config)["reg_lambda"]
            solved, intercept = own_state.ridge(penalty)
            out[config["config_id"], fold] = solved, penalty, own_state
            wide = np.zeros(len(names))
            wide[columns] = solved
            w = linear_weights(wide, intercept, settings, others)
            lines.append((config["config_id"], fold, w["lag"], w["std"], w["calendar"], w["key"], w["intercept"]))
            fit_times[config["config_id"], fold] = passed + perf_counter() - began
    histories = fold_histories(panel, folds, depth_of(*settings))
    began = perf_counter()
    state = histories.join(spark.createDataFrame(lines, FOLD_WEIGHTS), "fold")
    predicted = as_rows(linear_forecast(state, {n: F.col(n) for n in WEIGHTS}, settings[2], horizon), horizon, ("config_id", "fold", *KEYS))
    scored = score(predicted.withColumnRenamed(VALUE, "p").join(truth, [*KEYS, TIME]), ("config_id", "fold")).collect()
    took = (perf_counter() - began) / len(lines)
    errors = {(r["config_id"], r["fold"]): r["MAPE"] for r in scored}
    by_id = {c["config_id"]: json.dumps({**c, **effective(c)}) for c in configs}
    return [(c, fold, by_id[c], errors.get((c, fold)), spent, took) for (c, fold), spent in fit_times.items()]


def _trials(spark, panel, truth, folds, cuts, configs: list[dict], horizon, parallel_trials, keep_features) -> list[tuple]:
    """Trials of trees that have the same features: each is a fit of its own."""
    settings, others = feature_settings(configs[0]), other_features(configs[0])
    ready = features_of(panel, configs[0]).select(TIME, VALUE, "features")
    if keep_features:
        ready = ready.persist()
    histories = fold_histories(panel, folds, depth_of(*settings))

    def trial(job) -> tuple:
        config, (fold, train_end, origin) = job
        cut = F.timestamp_add("HOUR", F.lit(train_end).cast("int"), F.lit(str(origin)).cast("timestamp_ntz"))
        began = perf_counter()
        fitted = regressor(config).fit(ready.filter(F.col(TIME) < cut))
        elapsed = perf_counter() - began
        began = perf_counter()
        done = tree_forecast(histories.filter(F.col("fold") == fold).drop("fold"), fitted, settings, horizon, others)
        rows = score(as_rows(done, horizon).withColumnRenamed(VALUE, "p").join(truth, [*KEYS, TIME]), ()).collect()
        return config["config_id"], fold, json.dumps({**config, **effective(config)}), rows[0]["MAPE"], elapsed, perf_counter() - began

    try:
        with ThreadPool(parallel_trials) as pool:
            return pool.map(inheritable_thread_target(spark)(trial), list(product(configs, cuts)))
    finally:
        ready.unpersist()


def validation_summary(results: DataFrame) -> DataFrame:
    return mean_over_folds(results, measures=("MAPE", "fit_time", "prediction_time"))
