"""Extraction windows: bounds, range reads, backfills and completeness."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from panelcast.functions.hours import add_days, format_time, ntz, to_hour
from panelcast.schemas import (
    DATASET_END, DATASET_START, DAYS_DELAY, DAYS_EXPORT, RAW_TIME_FORMAT, TIME,
)

# Ways the rows of one day are spread in a backfill.
WINDOW_PARTS = 32


def export_windows(
    references: DataFrame,
    reference: str = "reference",
    days_delay: int = DAYS_DELAY,
    days_export: int = DAYS_EXPORT,
    dataset_start=DATASET_START,
    dataset_end=DATASET_END,
) -> DataFrame:
    """Add ``window_start`` and ``window_end`` for every reference time.

    The reference is floored to the hour and may not pass the dataset's end plus the delay. A window
    that would begin before the dataset moves as a whole, keeping its length.
    """
    latest = add_days(ntz(dataset_end), days_delay)
    anchor = F.least(to_hour(reference), latest)
    end = add_days(anchor, -days_delay)
    start = F.greatest(add_days(end, -days_export), ntz(dataset_start))
    moved = add_days(end, -days_export) < ntz(dataset_start)
    return references.withColumns({
        "window_start": start,
        "window_end": F.when(moved, add_days(ntz(dataset_start), days_export)).otherwise(end),
    })


def export_window(
    reference: datetime | None = None,
    days_delay: int = DAYS_DELAY,
    days_export: int = DAYS_EXPORT,
    dataset_start: datetime = DATASET_START,
    dataset_end: datetime = DATASET_END,
) -> tuple[datetime, datetime]:
    """Bounds of one run, for use as literals in a pushed-down filter."""
    delay, length = timedelta(days=days_delay), timedelta(days=days_export)
    anchor = dataset_end + delay
    if reference is not None:
        anchor = min(reference.replace(minute=0, second=0, microsecond=0), anchor)
    start = max(anchor - delay - length, dataset_start)
    return start, max(anchor - delay, start + length)


def between_hours(df: DataFrame, start, end, time: str = TIME, closed: str = "left") -> DataFrame:
    """Rows in [start, end), or [start, end] with ``closed='both'``."""
    if closed not in ("left", "both"):
        raise ValueError(f"closed must be 'left' or 'both', not {closed!r}")
    upper = F.col(time) <= ntz(end) if closed == "both" else F.col(time) < ntz(end)
    return df.filter((F.col(time) >= ntz(start)) & upper)


def since(df: DataFrame, start, time: str = TIME) -> DataFrame:
    return df.filter(F.col(time) >= ntz(start))


def daily_references(df: DataFrame, count: int, time: str = TIME) -> DataFrame:
    """The newest ``count`` daily reference times that end at the latest hour of the data."""
    back = F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    return (
        df.agg(F.max(time).alias("latest")).select("latest", back.alias("back"))
        .select(add_days("latest", -F.col("back")).alias("reference"))
    )


def backfill(panel: DataFrame, windows: DataFrame, time: str = TIME, parts: int = WINDOW_PARTS) -> DataFrame:
    """Rows of every window: a range join made an equi-join on the calendar day.

    Each window is exploded into the days it touches, so Spark hashes on the day and the exact
    bounds are a residual condition. A table has few days and many rows per day, so the rows of a day
    are dealt over ``parts`` and the (small) window days are copied to each part: if the join
    shuffles, its tasks are days times parts, whatever the number of series.
    """
    by_day = windows.select(
        "*", F.explode(F.sequence(F.to_date("window_start"), F.to_date("window_end"), F.expr("interval 1 day"))).alias("_day"),
    ).withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    rows = panel.withColumns({
        "_day": F.to_date(time), "_part": F.pmod(F.xxhash64(*panel.columns), F.lit(parts)).cast("int"),
    })
    inside = (rows[time] >= by_day["window_start"]) & (rows[time] < by_day["window_end"])
    same = (rows["_day"] == by_day["_day"]) & (rows["_part"] == by_day["_part"])
    return rows.join(by_day, same & inside).drop("_day", "_part")


def backfill_coverage(panel: DataFrame, windows: DataFrame, time: str = TIME) -> DataFrame:
    """Rows and distinct hours per window.

    The panel is reduced to one row per hour before the join, so the join no longer grows with the
    number of series.
    """
    hourly = panel.groupBy(time).agg(F.count(F.lit(1)).alias("rows_in_hour"))
    return (
        backfill(hourly, windows, time)
        .groupBy("window_start", "window_end")
        .agg(F.sum("rows_in_hour").alias("rows"), F.count(F.lit(1)).alias("hours"))
    )


def completeness(df: DataFrame, days_export: int = DAYS_EXPORT, time: str = TIME) -> DataFrame:
    """(expected, actual, ok): distinct hours over all series against the window length."""
    return df.agg(F.countDistinct(time).alias("actual")).select(
        F.lit(days_export * 24).cast("bigint").alias("expected"),
        "actual",
        (F.col("actual") >= days_export * 24).alias("ok"),
    )


def completeness_by_series(df: DataFrame, keys, days_export: int = DAYS_EXPORT, time: str = TIME) -> DataFrame:
    """The same test for each series, counting distinct hours.

    Equal (keys, hour) rows are merged before the count, so a series that holds much of the data is
    spread over its hours and only partial counts meet in one task.
    """
    return (
        df.groupBy(*keys, time).agg(F.count(F.lit(1)).alias("_rows"))
        .groupBy(*keys).agg(F.count(time).alias("actual"))
        .select(
            *keys,
            F.lit(days_export * 24).cast("bigint").alias("expected"),
            "actual",
            (F.col("actual") >= days_export * 24).alias("ok"),
        )
    )


def require_complete(df: DataFrame, days_export: int = DAYS_EXPORT, time: str = TIME) -> None:
    row = completeness(df, days_export, time).first()
    if not row["ok"]:
        raise RuntimeError(f"window has {row['actual']} distinct hours, {row['expected']} are required")


def export_metadata(
    df: DataFrame, start, end, source: str, days_delay: int = DAYS_DELAY,
    days_export: int = DAYS_EXPORT, time: str = TIME, datetime_format: str = RAW_TIME_FORMAT,
) -> DataFrame:
    """One row that describes an export."""
    def text(bound) -> Column:
        return format_time(ntz(bound), datetime_format)

    return df.agg(F.countDistinct(time).alias("num_unique_samples_per_time_series")).select(
        F.lit(days_delay).alias("days_delay"),
        F.lit(days_export).alias("days_export"),
        F.lit(source).alias("url"),
        text(start).alias("export_datetime_utc_start"),
        text(end).alias("export_datetime_utc_end"),
        F.lit(datetime_format).alias("datetime_format"),
        "num_unique_samples_per_time_series",
    )
