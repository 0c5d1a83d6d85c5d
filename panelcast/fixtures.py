"""Panels derived from the given ``events`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelcast.functions.hours import add_hours, to_hour
from panelcast.operators.clean import clean
from panelcast.operators.joins import fill_hours
from panelcast.operators.timeseries import seasonal_naive
from panelcast.schemas import FORECAST, OBSERVED, PANEL, RAW_TIME_FORMAT, TIME

# Event type -> consumer type, remainder of the user id -> area.
TYPE_OF_EVENT = {"click": 111, "error": 112, "purchase": 119, "signup": 121, "view": 122}
AREA_OF_USER = ("DK", "DK1", "DK2")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _type_code():
    cases = " ".join(f"when '{name}' then {number}" for name, number in TYPE_OF_EVENT.items())
    return F.expr(f"case event_type {cases} end")


def _user_area():
    names = ", ".join(f"'{a}'" for a in AREA_OF_USER)
    return F.expr(f"element_at(array({names}), cast(pmod(user_id, 3) + 1 as int))")


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed hourly records: events summed per hour, area and type, in the text form of the source."""
    hourly = (
        events(spark, sf_dir)
        .groupBy(to_hour("ts").alias("_hour"), _user_area().alias("PriceArea"), _type_code().alias("ConsumerType_DE35"))
        .agg(F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("TotalCon"))
    )
    return hourly.select(
        F.date_format("_hour", RAW_TIME_FORMAT).alias("HourUTC"),
        F.date_format(add_hours("_hour", 1), RAW_TIME_FORMAT).alias("HourDK"),
        "PriceArea", "ConsumerType_DE35", "TotalCon",
    )


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir).transform(clean).select(*PANEL.names)


def dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every observed series at every hour of the table's span; hours without a record are 0 and flagged."""
    return fill_hours(panel(spark, sf_dir), fill=0.0, span="table", observed=OBSERVED)


def latest(df: DataFrame):
    return df.agg(F.max(TIME)).scalar()


def _forecast_from(hourly: DataFrame, hours_back: int, horizon: int = 48) -> DataFrame:
    """Daily-naive forecast of an hourly panel cut ``hours_back`` before its end."""
    known = hourly.filter(F.col(TIME) <= add_hours(latest(hourly), -hours_back))
    return seasonal_naive(known, horizon, 24).select(*FORECAST.names)


def cached_forecasts(hourly: DataFrame) -> DataFrame:
    """Daily-naive forecast of the last 48 hours of an hourly panel."""
    return _forecast_from(hourly, 48)


def new_forecasts(hourly: DataFrame) -> DataFrame:
    """The same forecast made a day later: it overlaps the cached one for 24 hours."""
    return _forecast_from(hourly, 24)


def late_truth(observed: DataFrame, hours: int = 36) -> DataFrame:
    return observed.filter(F.col(TIME) > add_hours(latest(observed), -hours)).select(*FORECAST.names)


def user_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A panel that grows with the table: hourly totals per user, where one user holds a third of all rows."""
    user = F.when(F.col("user_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")).cast("bigint").alias("user_id")
    return (
        events(spark, sf_dir).groupBy(user, to_hour("ts").alias("hour"))
        .agg(F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total"))
    )
