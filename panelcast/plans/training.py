"""Search, evaluate, refit and register a pooled forecaster."""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from panelcast.operators.aggregates import best_config, label_splits, score, score_slices, split_profile
from panelcast.operators.forecast import (
    cross_validate, effective, evaluate, fit, forecast, grid_configs, observed, validation_summary,
)
from panelcast.operators.joins import pair
from panelcast.operators.timeseries import label_folds, label_last_hours, lags, seasonal_naive
from panelcast.schemas import HORIZON, KEYS, VALUE
from panelcast.sources.commits import claim, head, new_folder
from panelcast.sources.models import register_model
from panelcast.sources.results import record_run

BEST_CONFIG = "config_id int, MAPE double, fit_time double, prediction_time double, config string"
TRAINING_RUN = "model string, version int, config string, splits string, errors string, worst_slices string"
# Series with the largest errors that a training record shows; all of them are stored with the model.
WORST_SLICES = 100
# What stands for missing hours unless a configuration says otherwise.
FILL = "zero"


def split(panel: DataFrame, horizon: int = HORIZON) -> tuple[DataFrame, DataFrame]:
    labelled = label_last_hours(panel, horizon)
    return (
        labelled.filter(F.col("split") == "train").drop("split"),
        labelled.filter(F.col("split") == "test").drop("split"),
    )


def search(panel: DataFrame, parameters: dict[str, list], horizon: int = HORIZON, k: int = 3) -> DataFrame:
    """The best configuration of a grid, whole, as a one-row table."""
    results = cross_validate(panel, grid_configs(parameters), horizon, k)
    return best_of(results)


def best_of(results: DataFrame) -> DataFrame:
    chosen = results.select("config_id", "config").distinct()
    return best_config(validation_summary(results)).join(chosen, "config_id")


def publish_best(best: DataFrame, root: str) -> None:
    """Commit the configuration as the newest one; earlier ones stay in the log."""
    folder = new_folder(f"{root.rstrip('/')}/configs", "best")
    best.coalesce(1).write.json(folder)
    claim(best.sparkSession, f"{root.rstrip('/')}/configs", "best_config", lambda _: [folder])


def read_best(spark: SparkSession, root: str, schema: str = BEST_CONFIG) -> DataFrame:
    """The published configuration; training cannot start without one."""
    found = head(spark, f"{root.rstrip('/')}/configs").of("best_config")
    if not found:
        raise FileNotFoundError("no best configuration has been published; run the search first")
    return spark.read.schema(schema).json(found[max(found, key=int)][0])


def published_config(spark: SparkSession, root: str) -> dict:
    """The settings of the published configuration, as training takes them."""
    return json.loads(read_best(spark, root).first()["config"])


def baseline_pairs(train: DataFrame, test: DataFrame, horizon: int = HORIZON) -> DataFrame:
    return pair(observed(test), seasonal_naive(train, horizon))


def compare_with_baseline(
    model: PipelineModel, train: DataFrame, test: DataFrame, horizon: int = HORIZON,
) -> DataFrame:
    """(model, RMSPE, MAPE) of the seasonal baseline and the fitted model on the test hours."""
    pairs = label_splits({
        "baseline": baseline_pairs(train, test, horizon), "model": evaluate(model, train, test, horizon),
    }, "model")
    return score(pairs, ("model",))


def refit_and_forecast(
    train: DataFrame, test: DataFrame, config: dict, horizon: int = HORIZON,
) -> tuple[PipelineModel, DataFrame]:
    """Fit on all hours and forecast the ``horizon`` hours after the test split."""
    everything = train.unionByName(test)  # a fit does not depend on the order of rows
    model = fit(everything, config)
    return model, forecast(model, everything, horizon)


def train_and_register(
    spark: SparkSession, panel: DataFrame, root: str, config: dict | None = None, horizon: int = HORIZON, name: str = "best_model",
) -> int:
    """Score on the test hours, refit on everything, store as a new version; returns the version.

    Without a configuration, the published one is used. Its ``fill`` says what stands for missing hours of the history; it
    is stored with the model, and predictions use it. The errors of all slices are stored with the model.
    """
    config = published_config(spark, root) if config is None else config
    kept = panel.persist()  # split, fits, scores and the refit all read it
    try:
        train, test = split(kept, horizon)
        fitted = fit(train, config)
        pairs = evaluate(fitted, train, test, horizon, config.get("fill", FILL))
        final, _ = refit_and_forecast(train, test, config, horizon)
        slices = score_slices(pairs).where("not overall").drop("overall")
        version = register_model(spark, final, score(pairs), root, name, {"fill": FILL, **config}, slices)
        record_run(_training_run(spark, fitted, train, test, config, horizon, version, name), root, "training")
    finally:
        kept.unpersist()
    return version


def _training_run(spark: SparkSession, model: PipelineModel, train: DataFrame, test: DataFrame, config: dict, horizon: int, version: int, name: str) -> DataFrame:
    """One row: model and version, configuration, spans of both splits, and errors of baseline, model and slices."""
    spans = split_profile(label_splits({"train": train, "test": test})).select(
        F.struct("split", F.col("t_min").cast("string").alias("t_min"), F.col("t_max").cast("string").alias("t_max"), "dataset_size").alias("s"))
    errors = compare_with_baseline(model, train, test, horizon).select(F.struct("model", "RMSPE", "MAPE").alias("e"))
    slices = score_slices(evaluate(model, train, test, horizon)).where("not overall").drop("overall")
    row = spans.agg(F.collect_list("s").alias("splits")).select(
        F.lit(name).alias("model"), F.lit(version).alias("version"), F.lit(json.dumps({**config, **effective(config)})).alias("config"),
        F.to_json("splits").alias("splits"))
    return row.withColumns({
        "errors": errors.agg(F.to_json(F.collect_list("e"))).scalar(),
        "worst_slices": slices.orderBy(F.desc("MAPE"), *KEYS).limit(WORST_SLICES).agg(F.to_json(F.collect_list(F.struct("*")))).scalar(),
    })


def season_trials(panel: DataFrame, seasons, horizon: int = HORIZON, k: int = 3) -> DataFrame:
    """Fold results (config_id, season, fold, MAPE) of the seasonal baseline with several seasons.

    A season is at least as long as the horizon, so its forecast of an hour is the value one season
    earlier: all trials come from one pass with a lag per season.
    """
    if min(seasons) < horizon:
        raise ValueError("a season must not be shorter than the horizon")
    earlier = lags(panel, seasons)
    folded = label_folds(earlier, horizon, k).filter(F.col("split") == "test").transform(observed)
    trials = F.array(*[
        F.struct(F.lit(i).alias("config_id"), F.lit(s).alias("season"), F.col(f"lag_{s}").alias("p"))
        for i, s in enumerate(seasons)
    ])
    pairs = folded.select("fold", F.col(VALUE).alias("y"), F.inline(trials))
    return score(pairs, ("config_id", "season", "fold")).drop("RMSPE")
