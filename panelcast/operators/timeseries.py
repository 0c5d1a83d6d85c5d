"""Per-series windows, splits and folds.

Look-back features only need a bounded number of earlier hours. They run in windows partitioned by
series *and* time bucket; the last hours of a bucket are copied into the next one, so each window
partition is small and a single long or hot series is spread over many tasks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelcast.functions.hours import add_hours, day_of_week, epoch_hour, hour_of_day
from panelcast.schemas import HORIZON, KEYS, TIME, VALUE

BUCKET_HOURS = 720
# Spark's own limit for filtering ranks before a shuffle (spark.sql.optimizer.windowGroupLimitThreshold).
GROUP_LIMIT = 1000
LAGS = tuple(range(1, 73))
MEAN_WINDOWS = ((1, 24), (1, 48), (1, 72))
STD_WINDOWS = ((1, 24), (1, 48), (1, 72))


def bucketed(df: DataFrame, halo: int, time: str = TIME, bucket_hours: int = BUCKET_HOURS) -> DataFrame:
    """Add ``_hour``, ``_bucket`` and ``_halo``; the last ``halo`` hours of a bucket are repeated in the next."""
    size = max(bucket_hours, halo)
    hour = F.col("_hour")
    home = F.floor(hour / size)
    near_end = F.pmod(hour, F.lit(size)) >= size - halo
    return (
        df.withColumn("_hour", epoch_hour(time))
        .withColumn("_bucket", F.explode(F.when(near_end, F.array(home, home + 1)).otherwise(F.array(home))))
        .withColumn("_halo", F.col("_bucket") != home)
    )


def look_back(
    df: DataFrame, columns: dict[str, Column], halo: int, keys=KEYS, time: str = TIME,
    bucket_hours: int = BUCKET_HOURS,
) -> DataFrame:
    """Add window columns that look at most ``halo`` hours back.

    The rows are dealt by series *and* bucket even when they are already together by series, or a
    long series would stay in one task.
    """
    return (
        bucketed(df, halo, time, bucket_hours).repartition(*keys, "_bucket").withColumns(columns)
        .filter(~F.col("_halo")).drop("_hour", "_bucket", "_halo")
    )


def hours_before(first: int, last: int, keys=KEYS) -> Window:
    """Window of the hours ``first`` to ``last`` before a row, by clock and not by row count."""
    return (
        Window.partitionBy(*keys, "_bucket").orderBy("_hour").rangeBetween(-last, -first)
    )


def lags(df: DataFrame, offsets=LAGS, keys=KEYS, time: str = TIME, value: str = VALUE) -> DataFrame:
    """Value ``k`` hours earlier for each offset; NULL where that hour has no row.

    Each offset is a frame of its own in one Window operator. For all lags of an hourly panel use
    ``history``, which needs a single frame.
    """
    columns = {f"lag_{k}": F.first(value).over(hours_before(k, k, keys)) for k in offsets}
    return look_back(df, columns, max(offsets), keys, time)


def _over_full_window(aggregate, windows, prefix: str, keys, value: str) -> dict[str, Column]:
    columns = {}
    for shift, length in windows:
        frame = hours_before(shift, shift + length - 1, keys)
        full = F.count(value).over(frame) == length
        columns[f"{prefix}_{shift}_{length}"] = F.when(full, aggregate(value).over(frame))
    return columns


def _reach(windows) -> int:
    return max(shift + length - 1 for shift, length in windows)


def rolling_mean(df: DataFrame, windows=MEAN_WINDOWS, keys=KEYS, time: str = TIME, value: str = VALUE) -> DataFrame:
    """Mean of ``length`` hours ending ``shift`` hours back; NULL unless all hours are present."""
    return look_back(df, _over_full_window(F.avg, windows, "mean", keys, value), _reach(windows), keys, time)


def rolling_std(df: DataFrame, windows=STD_WINDOWS, keys=KEYS, time: str = TIME, value: str = VALUE) -> DataFrame:
    """Sample standard deviation over the same kind of window."""
    return look_back(df, _over_full_window(F.stddev_samp, windows, "std", keys, value), _reach(windows), keys, time)


def window_columns(lags=LAGS, means=MEAN_WINDOWS, stds=STD_WINDOWS, keys=KEYS, value: str = VALUE) -> dict[str, Column]:
    """Lags, rolling means and rolling standard deviations as columns of one ``look_back``; NULL where an hour is missing."""
    return {
        **{f"lag_{k}": F.first(value).over(hours_before(k, k, keys)) for k in lags},
        **_over_full_window(F.avg, means, "mean", keys, value),
        **_over_full_window(F.stddev_samp, stds, "std", keys, value),
    }


def history(df: DataFrame, length: int = 72, keys=KEYS, time: str = TIME, value: str = VALUE) -> DataFrame:
    """The previous ``length`` hours of a row as one array, oldest first.

    One window expression carries all lags. The series must be hourly (see ``fill_hours``); a
    missing value leaves a shorter array.
    """
    column = F.collect_list(value).over(hours_before(1, length, keys))
    return look_back(df, {"history": column}, length, keys, time)


def full_history(df: DataFrame, length: int = 72) -> DataFrame:
    return df.filter(F.size("history") == length)


def calendar(df: DataFrame, time: str = TIME) -> DataFrame:
    return df.withColumns({"day_of_week": day_of_week(time), "hour_of_day": hour_of_day(time)})


def newest(df: DataFrame, count: int, keys=KEYS, time: str = TIME, bucket_hours: int = BUCKET_HOURS) -> DataFrame:
    """The newest ``count`` rows of every series.

    Up to ``GROUP_LIMIT`` rows the rank filter is applied by each task before the shuffle (window group limit), so a hot
    series sends at most ``count`` rows per task. Beyond that, the rows of each time bucket of a series are counted; buckets
    that are wholly among the newest are kept, and only the one that ``count`` cuts is ranked. No size of ``count`` sorts
    a series in one task.
    """
    if count <= GROUP_LIMIT:
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(time).desc()))
        return df.withColumn("_rank", rank).filter(F.col("_rank") <= count).drop("_rank")
    bucket = F.floor(epoch_hour(time) / bucket_hours)
    newer = Window.partitionBy(*keys).orderBy(F.desc("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    kept = (
        df.groupBy(*keys, bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_left", count - F.coalesce(F.sum("_rows").over(newer), F.lit(0))).filter(F.col("_left") > 0)
    )
    rank = F.row_number().over(Window.partitionBy(*keys, "_bucket").orderBy(F.col(time).desc()))
    rows = df.withColumn("_bucket", bucket).join(kept, [*keys, "_bucket"])
    whole = rows.filter(F.col("_rows") <= F.col("_left")).select(*df.columns)
    cut = rows.filter(F.col("_rows") > F.col("_left")).withColumn("_rank", rank).filter(F.col("_rank") <= F.col("_left"))
    return whole.unionByName(cut.select(*df.columns))


def label_last_hours(
    df: DataFrame, horizon: int = HORIZON, keys=KEYS, time: str = TIME, label: str = "split",
) -> DataFrame:
    """Label the last ``horizon`` rows of each series ``test`` and the others ``train``.

    The cut of a series is the oldest of its newest rows, found without sorting the whole series.
    Joining one cut per series back lets Spark choose by size, and split a hot series if it shuffles.
    """
    cuts = newest(df.select(*keys, time), horizon, keys, time).groupBy(*keys).agg(F.min(time).alias("_cut"))
    return df.join(cuts, list(keys)).withColumn(
        label, F.when(F.col(time) >= F.col("_cut"), "test").otherwise("train")
    ).select(*df.columns, label)


def fold_bounds(df: DataFrame, horizon: int = HORIZON, k: int = 3, time: str = TIME) -> DataFrame:
    """Expanding folds (fold, origin, train_end, test_end) in hours from the table's first hour.

    With n distinct hours the step is n // k and the first window max(3 * horizon, step - horizon).
    Fold i trains on [0, train_end) and tests on [train_end, test_end), as long as the test fits.
    Fewer than 10 * horizon hours fail the job.
    """
    few = F.raise_error(F.concat(F.lit("too few hours for cross-validation: "), F.col("n").cast("string")))
    step = F.floor(F.col("n") / k)
    initial = F.greatest(F.lit(3 * horizon), F.col("step") - horizon)
    starts = F.sequence(F.col("first_window"), F.col("n") - horizon, F.col("step"))
    return (
        df.agg(F.countDistinct(time).alias("n"), F.min(time).alias("origin"))
        .withColumn("n", F.when(F.col("n") < 10 * horizon, few.cast("bigint")).otherwise(F.col("n")))
        .withColumn("step", step).withColumn("first_window", initial)
        .select("origin", F.posexplode(starts).alias("fold", "train_end"))
        .select("fold", "origin", "train_end", (F.col("train_end") + horizon).alias("test_end"))
    )


def label_folds(
    df: DataFrame, horizon: int = HORIZON, k: int = 3, keys=KEYS, time: str = TIME,
) -> DataFrame:
    """Each row once per fold that uses it, labelled ``train`` or ``test``.

    The bounds are one short array, read as a scalar, so no join is needed.
    """
    bounds = fold_bounds(df, horizon, k, time)
    folds = bounds.agg(F.array_sort(F.collect_list(F.struct("fold", "origin", "train_end", "test_end")))).scalar()
    hour = F.timestamp_diff("HOUR", F.col("_fold.origin"), F.col(time))
    return (
        df.withColumn("_fold", F.explode(folds))
        .filter(hour < F.col("_fold.test_end"))
        .select(
            *df.columns, F.col("_fold.fold").alias("fold"),
            F.when(hour < F.col("_fold.train_end"), "train").otherwise("test").alias("split"),
        )
    )


def horizon_steps(df: DataFrame, horizon: int = HORIZON, keys=KEYS) -> DataFrame:
    """Steps 1..horizon for every series of the table."""
    return df.select(*keys).distinct().withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))


def shift_hours(df: DataFrame, hours: int, time: str = TIME) -> DataFrame:
    return df.withColumn(time, add_hours(time, hours))


def seasonal_naive(
    df: DataFrame, horizon: int = HORIZON, season: int | None = None, keys=KEYS, time: str = TIME,
    value: str = VALUE,
) -> DataFrame:
    """Repeat the last season of each series: step h takes the value of hour T + ((h-1) mod s) + 1 - s.

    T is the series' own last hour and the season defaults to the horizon.
    """
    season = season or horizon
    last = F.max(time).over(Window.partitionBy(*keys))
    recent = newest(df.select(*keys, time, value), season, keys, time).withColumn("_last", last)
    repeats = F.explode(F.sequence(F.lit(1), F.lit(math.ceil(horizon / season))))
    return (
        recent.filter(F.col(time) > add_hours("_last", -season))
        .withColumn("_repeat", repeats)
        .withColumn(time, add_hours(time, F.col("_repeat") * season))
        .filter(F.col(time) <= add_hours("_last", horizon))
        .select(*keys, time, value)
    )


def append_sorted(first: DataFrame, second: DataFrame, keys=KEYS, time: str = TIME) -> DataFrame:
    """Both tables' rows, none merged, in series and hour order."""
    return first.unionByName(second).orderBy(*keys, time)
