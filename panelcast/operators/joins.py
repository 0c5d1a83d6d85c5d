"""Joins between forecasts, observations and calendars.

Every join of panels is on the full row key (series and hour), which is unique per row, so the
shuffle stays even when one series holds a large share of the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from panelcast.functions.hours import add_hours
from panelcast.schemas import KEYS, ROW_KEYS, TIME, VALUE

# Number of ways the smaller key set is spread when two key sets are multiplied.
PARTS_PER_CORE = 2


def merge_versions(new: DataFrame, cached: DataFrame, on=ROW_KEYS, value: str = VALUE) -> DataFrame:
    """Full outer join of two forecast tables with ``_new`` and ``_cached`` values."""
    left = new.select(*on, F.col(value).alias(f"{value}_new"))
    right = cached.select(*on, F.col(value).alias(f"{value}_cached"))
    return left.join(right, list(on), "full_outer")


def overlay(merged: DataFrame, on=ROW_KEYS, value: str = VALUE) -> DataFrame:
    """The cached value wins where it is present: the first published forecast is kept."""
    return merged.select(*on, F.coalesce(f"{value}_cached", f"{value}_new").alias(value))


def attach_truth(
    forecasts: DataFrame, observed: DataFrame, on=ROW_KEYS, value: str = VALUE,
) -> DataFrame:
    """Forecast and observation side by side, on hours that have both.

    A left update join whose missing matches are dropped is an inner join, so it is written as one.
    """
    predicted = forecasts.select(*on, F.col(value).alias(f"{value}_predictions"))
    actual = observed.filter(F.col(value).isNotNull()).select(*on, F.col(value).alias(f"{value}_observations"))
    return predicted.join(actual, list(on))


def update_from(
    df: DataFrame, late: DataFrame, on=ROW_KEYS, column: str = f"{VALUE}_observations", value: str = VALUE,
) -> DataFrame:
    """Left update join: non-missing late values replace the stored ones, all rows are kept."""
    incoming = late.select(*on, F.col(value).alias("_late"))
    joined = df.join(incoming, list(on), "left")
    return joined.withColumn(column, F.coalesce("_late", column)).select(*df.columns)


def pair(actual: DataFrame, forecast: DataFrame, on=ROW_KEYS, value: str = VALUE) -> DataFrame:
    """Actual ``y`` and forecast ``p`` of the same series and hour."""
    return actual.select(*on, F.col(value).alias("y")).join(
        forecast.select(*on, F.col(value).alias("p")), list(on)
    )


def misaligned(left: DataFrame, right: DataFrame, on=ROW_KEYS) -> DataFrame:
    """Rows whose key is on one side only, labelled with that side; empty when both align.

    One full outer join sees both directions in a single shuffle.
    """
    a = left.select(*on, F.lit(True).alias("_l"))
    b = right.select(*on, F.lit(True).alias("_r"))
    one_sided = a.join(b, list(on), "full_outer").filter(F.col("_l").isNull() | F.col("_r").isNull())
    return one_sided.select(*on, F.when(F.col("_l").isNull(), "right").otherwise("left").alias("only_in"))


def key_product(df: DataFrame, *keys: str) -> DataFrame:
    """Every value of each key with every value of the others, seen together or not; by default of the series' keys.

    The combinations are the result, so their number is given. Each further key is added by an equi-join on a part number:
    the combinations so far are dealt over the parts, the key's values are copied to each part, and every part builds its
    share. There are as many parts as ``PARTS_PER_CORE`` for each core of the cluster, but no more than combinations.
    """
    first, *others = keys or KEYS
    most = df.sparkSession.sparkContext.defaultParallelism * PARTS_PER_CORE
    result = df.select(first).distinct()
    for i, key in enumerate(others, 1):
        seen = F.lit(1).cast("long")
        for k in (first, *others)[:i]:
            seen = seen * F.greatest(F.approx_count_distinct(k), F.lit(1))
        parts = df.agg(F.least(seen, F.lit(most)).cast("int")).scalar()
        copied = df.select(key).distinct().withColumn("_parts", parts).withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
        dealt = result.withColumn("_part", F.pmod(F.hash(*(first, *others)[:i]), parts))
        result = dealt.join(copied.drop("_parts"), "_part").drop("_part")
    return result.select(first, *others)


def horizon_grid(df: DataFrame, horizon: int, keys=KEYS, time: str = TIME) -> DataFrame:
    """Key product times the ``horizon`` hours that follow the latest hour of the whole table."""
    return key_product(df, *keys).transform(attach_hours, df, horizon, time)


def attach_hours(series: DataFrame, df: DataFrame, horizon: int, time: str = TIME) -> DataFrame:
    """Each row of ``series`` with each of the hours that follow the latest hour of ``df``."""
    latest = df.agg(F.max(time)).scalar()
    step = F.explode(F.sequence(F.lit(1), F.lit(horizon)))
    return (
        series.withColumn("_latest", latest).withColumn("_step", step)
        .withColumn(time, add_hours("_latest", "_step")).drop("_latest", "_step")
    )


def fill_hours(
    df: DataFrame, keys=KEYS, time: str = TIME, value: str = VALUE, fill: float | None = None,
    span: str = "series", observed: str | None = None,
) -> DataFrame:
    """Make every series hourly; hours without a row get NULL, or ``fill``.

    ``span='series'`` runs from each series' first to last hour, ``span='table'`` from the table's.
    ``observed`` names a boolean column that tells hours with a value in ``df`` from filled ones. A
    series with two rows for one hour, or with a row that is not on a full hour, fails the job.

    The work is done by (series, day): a day's rows fold map-side into 24 columns, a window over the
    days of a series finds the gaps between them, and only then does a day become 24 rows. Nothing
    hourly is shuffled, no calendar is joined, and no task holds more of a series than its days.
    """
    if span not in ("series", "table"):
        raise ValueError(f"span must be 'series' or 'table', not {span!r}")
    days = df.groupBy(*keys, F.to_date(time).alias("_day")).agg(
        F.count(F.lit(1)).alias("_rows"), F.min(time).alias("_lo"), F.max(time).alias("_hi"),
        *[F.expr(f"max(case when hour(`{time}`) = {h} then `{value}` end) as _v{h}") for h in range(24)],
        F.bit_or(F.call_function("shiftleft", F.lit(1), F.hour(time))).alias("_seen"),
        F.max(F.when(F.col(time) != F.date_trunc("hour", time), F.col(time))).alias("_off"),
    )
    at_fault = (
        F.when(F.col("_off").isNotNull(), F.raise_error(F.concat(F.lit("not on a full hour: "), F.col("_off").cast("string"))))
        .when(F.col("_rows") > F.bit_count("_seen"), F.raise_error(F.concat(F.lit("more than one row for an hour of "), F.col("_day").cast("string"))))
    ).cast("array<double>")
    values = F.expr(f"array({', '.join(f'_v{h}' for h in range(24))})")
    days = days.select(*keys, "_day", "_lo", "_hi", F.coalesce(at_fault, values).alias("_values"))
    series = Window.partitionBy(*keys)
    if span == "series":
        first, last = F.min("_lo").over(series), F.max("_hi").over(series)
    else:
        first, last = df.agg(F.min(time)).scalar(), df.agg(F.max(time)).scalar()
    by_day = series.orderBy("_day")
    bounded = days.withColumns({
        "_first": first, "_last": last, "_before": F.lag("_day").over(by_day), "_next": F.lead("_day").over(by_day),
    })
    one = F.expr("interval 1 day")
    start = F.when(F.col("_before").isNull(), F.to_date("_first")).otherwise(F.col("_day"))
    end = F.when(F.col("_next").isNull(), F.to_date("_last")).otherwise(F.date_sub("_next", 1))
    empty_day = F.array_repeat(F.lit(None).cast("double"), 24)
    filled = F.col("_value") if fill is None else F.coalesce("_value", F.lit(fill))
    extra = [F.col("_value").isNotNull().alias(observed)] if observed else []
    return (
        bounded.withColumn("_date", F.explode(F.sequence(start, end, one)))
        .withColumn("_hours", F.when(F.col("_date") == F.col("_day"), F.col("_values")).otherwise(empty_day))
        .select(*keys, "_first", "_last", "_date", F.posexplode("_hours").alias("_hour", "_value"))
        .withColumn(time, add_hours(F.col("_date").cast("timestamp_ntz"), "_hour"))
        .filter(F.col(time).between(F.col("_first"), F.col("_last")))
        .select(*keys, time, filled.alias(value), *extra)
    )
