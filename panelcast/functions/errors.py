"""Percentage errors as built-in expressions, so they aggregate map-side."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from panelcast.schemas import EPSILON


def absolute_percentage_error(actual, forecast) -> Column:
    """|y - p| / max(|y|, epsilon); a fraction, not percent."""
    actual = F.col(actual) if isinstance(actual, str) else actual
    forecast = F.col(forecast) if isinstance(forecast, str) else forecast
    return F.abs(actual - forecast) / F.greatest(F.abs(actual), F.lit(EPSILON))


def mape(actual, forecast) -> Column:
    return F.avg(absolute_percentage_error(actual, forecast))


def rmspe(actual, forecast) -> Column:
    error = absolute_percentage_error(actual, forecast)
    return F.sqrt(F.avg(error * error))
