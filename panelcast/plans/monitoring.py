"""Scoring of cached forecasts against late observations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelcast.operators.aggregates import mape_per_hour
from panelcast.operators.joins import attach_truth
from panelcast.operators.windows import between_hours
from panelcast.plans.prediction import forecast_span
from panelcast.schemas import FORECAST, METRICS, TIME, VALUE
from panelcast.sources.feature_table import read_range
from panelcast.sources.results import publish, read_published


def truth_of_span(observed: DataFrame, first, last) -> DataFrame:
    """All observations between the first and last forecast hour, both included."""
    return between_hours(observed, first, last, closed="both").select(*FORECAST.names)


def hourly_scores(forecasts: DataFrame, truth: DataFrame) -> DataFrame:
    """MAPE per hour on the hours that have both a forecast and an observation."""
    return mape_per_hour(
        attach_truth(forecasts, truth), TIME, f"{VALUE}_observations", f"{VALUE}_predictions"
    )


def run_monitoring(spark: SparkSession, table: str, root: str) -> str:
    """Replace the published metrics and truth; says which step found nothing to do."""
    forecasts = read_published(spark, root, "predictions_monitoring", FORECAST)
    if forecasts.isEmpty():
        return "no forecasts"
    first, last = forecast_span(forecasts)
    truth = read_range(spark, table, first, last, closed="both").select(*FORECAST.names)
    if truth.isEmpty():
        return "no observations"
    metrics = hourly_scores(forecasts, truth).persist()
    try:
        if metrics.isEmpty():
            return "no overlap"
        publish({"metrics_monitoring": metrics, "y_monitoring": truth}, root)
    finally:
        metrics.unpersist()
    return "published"


def published_metrics(spark: SparkSession, root: str) -> DataFrame:
    return read_published(spark, root, "metrics_monitoring", METRICS)


def published_truth(spark: SparkSession, root: str) -> DataFrame:
    return read_published(spark, root, "y_monitoring", FORECAST)
