"""Batch prediction: forecast every series, publish, and merge into the forecast cache."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from panelcast.functions.hours import ntz
from panelcast.operators.aggregates import time_span
from panelcast.operators.clean import AttachKeys, drop_missing, key_rows, split_target
from panelcast.operators.forecast import forecast
from panelcast.operators.joins import horizon_grid, key_product, merge_versions, overlay
from panelcast.operators.windows import since
from panelcast.plans.ingest import FEATURE_RUN
from panelcast.schemas import FORECAST, HORIZON, RAW_TIME_FORMAT, TIME
from panelcast.sources.feature_table import read_range
from panelcast.sources.models import load_model, model_config
from panelcast.sources.results import latest_run, publish, read_published, update_days

#: The policy for missing hours that is stored with the model.
STORED = "stored"


def forecast_inputs(panel: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """Keys and hours to forecast, with the keys as features."""
    return AttachKeys().transform(horizon_grid(panel, horizon))


def merge_into_cache(predictions: DataFrame, cached: DataFrame, start) -> DataFrame:
    """First published forecasts win; hours before ``start`` and missing values leave the cache."""
    return (
        overlay(merge_versions(predictions, cached)).transform(since, start).transform(drop_missing)
        .select(*FORECAST.names)
    )


def update_cache(spark: SparkSession, predictions: DataFrame, root: str, start) -> DataFrame:
    """Merge predictions into the stored cache, day by day, and return the new cache."""
    update_days(spark, root, "predictions_monitoring", FORECAST, predictions, ntz(start), lambda new, cached: merge_into_cache(new, cached, start))
    return read_published(spark, root, "predictions_monitoring", FORECAST)


def last_ingested(spark: SparkSession, root: str) -> tuple[datetime, datetime]:
    """The window of the newest ingest."""
    run = latest_run(spark, root, "feature", FEATURE_RUN).first()
    form = RAW_TIME_FORMAT.replace("yyyy", "%Y").replace("MM", "%m").replace("dd", "%d").replace("HH", "%H").replace("mm", "%M")
    return tuple(datetime.strptime(run[f"export_datetime_utc_{end}"], form) for end in ("start", "end"))


def run_prediction(
    spark: SparkSession, table: str, models: str, root: str, start=None, end=None, horizon: int = HORIZON,
    model_name: str = "best_model", model_version: int | None = None, fill: str | None = STORED, runs: str | None = None,
) -> DataFrame:
    """Read the range, forecast all key pairs, publish X, y and predictions, update the cache.

    Without ``start`` and ``end`` the range is that of the last ingest, from the run records below
    ``runs``; without a version the newest model is taken. Missing hours are filled as the model was registered with,
    unless ``fill`` says otherwise. Returns the published predictions.
    """
    if start is None or end is None:
        first, last = last_ingested(spark, runs or root)
        start, end = first if start is None else start, last if end is None else end
    panel = read_range(spark, table, start, end).transform(key_rows)
    exogenous, target = split_target(panel)
    model = load_model(spark, models, model_name, model_version)
    if fill == STORED:
        fill = model_config(spark, models, model_name, model_version).get("fill", "zero")
    predictions = forecast(model, panel, horizon, key_product(panel), fill).select(*FORECAST.names)
    publish({"X": exogenous, "y": target, "predictions": predictions}, root)
    published = read_published(spark, root, "predictions", FORECAST)
    update_cache(spark, published, root, start)
    return published


def forecast_span(predictions: DataFrame) -> tuple:
    """First and last forecast hour."""
    row = time_span(predictions, TIME).first()
    return row["t_min"], row["t_max"]
