"""Result pages: the read side as one job for all series instead of one per request."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from panelcast.functions.hours import epoch_hour, from_epoch_hour
from panelcast.functions.payloads import field_of, ordered_pairs
from panelcast.operators.aggregates import PAGE_HOURS, label_splits, page_of, pages
from panelcast.operators.hooks import rows_of
from panelcast.operators.joins import fill_hours
from panelcast.operators.timeseries import newest
from panelcast.schemas import DISPLAY_HOURS, KEYS, TIME, VALUE


def key_values(df: DataFrame, key: str) -> DataFrame:
    """(value, rows) of a key, one row per distinct value, in order."""
    return df.groupBy(F.col(key).cast("int").alias("value")).agg(F.count(F.lit(1)).alias("rows")).orderBy("value")


def series_pages(observed: DataFrame, predictions: DataFrame, hours: int = DISPLAY_HOURS) -> DataFrame:
    """Newest observations and current forecasts of each series as parallel arrays.

    Series that miss either side have no page. Both lists are bounded: by ``hours`` and by the
    forecast horizon.
    """
    recent = newest(observed, hours).groupBy(*KEYS).agg(ordered_pairs(epoch_hour(TIME), F.col(VALUE)).alias("_obs"))
    ahead = predictions.groupBy(*KEYS).agg(ordered_pairs(epoch_hour(TIME), F.col(VALUE)).alias("_preds"))
    return recent.join(ahead, list(KEYS)).select(
        *KEYS,
        field_of("_obs", "t").alias("datetime_utc"), field_of("_obs", "v").alias("energy_consumption"),
        field_of("_preds", "t").alias("preds_datetime_utc"),
        field_of("_preds", "v").alias("preds_energy_consumption"),
    )


def metrics_page(metrics: DataFrame, page_hours: int = PAGE_HOURS) -> DataFrame:
    """Hours and MAPE as parallel arrays, one row per page of hours."""
    return pages(metrics, (), TIME, ("MAPE",), page_hours, {"MAPE": "mape"})


def comparison_pages(truth: DataFrame, forecasts: DataFrame, page_hours: int = PAGE_HOURS) -> DataFrame:
    """Observations and cached forecasts of each series side by side, one row per page of hours.

    Series that miss either side have no page.
    """
    sides = {"y_monitoring": truth, "predictions_monitoring": forecasts}
    both = label_splits({s: df.select(*KEYS, TIME, VALUE) for s, df in sides.items()}, "side")
    hour = epoch_hour(TIME)
    listed = both.withColumn("page", page_of(TIME, page_hours)).groupBy(*KEYS, "page").agg(*[
        F.array_sort(F.array_compact(F.collect_list(
            F.when(F.col("side") == s, F.struct(hour.alias("t"), F.col(VALUE).alias("v")))
        ))).alias(f"_{s}") for s in sides
    ])
    whole = Window.partitionBy(*KEYS)
    complete = listed.withColumns({f"_has_{s}": F.max(F.size(f"_{s}")).over(whole) for s in sides})
    return complete.filter(F.col("_has_y_monitoring") * F.col("_has_predictions_monitoring") > 0).select(
        *KEYS, "page",
        *[field_of(f"_{s}", "t").alias(f"{s}_{TIME}") for s in sides],
        *[field_of(f"_{s}", "v").alias(f"{s}_{VALUE}") for s in sides],
    )


def continuous_frame(page: DataFrame, time: str = TIME, value: str = VALUE) -> DataFrame:
    """Arrays of epoch hours and values back to an hourly table without holes."""
    rows = rows_of(page, time, value, keep=KEYS)
    return fill_hours(rows.withColumn(time, from_epoch_hour(time)), KEYS, time, value)
