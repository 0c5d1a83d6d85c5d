"""Aggregations over series, hours and splits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelcast.functions.errors import absolute_percentage_error, mape, rmspe
from panelcast.functions.hours import epoch_hour
from panelcast.functions.payloads import field_of
from panelcast.schemas import KEYS, TIME, VALUE

# Hours in one page of a result list: a leap year.
PAGE_HOURS = 8784


def distinct_values(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).distinct().orderBy(key)


def time_span(df: DataFrame, time: str = TIME, by=()) -> DataFrame:
    return df.groupBy(*by).agg(F.min(time).alias("t_min"), F.max(time).alias("t_max"))


def count_hours(df: DataFrame, time: str = TIME, approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct(time) if approximate else F.countDistinct(time)
    return df.agg(count.alias("hours"))


def split_profile(df: DataFrame, keys=KEYS, time: str = TIME, value: str = VALUE, label: str = "split") -> DataFrame:
    """Span, rows and distinct keys of each split, with its target and feature columns.

    Rows are merged to one per (split, series) first, so the distinct counts run on that small
    table and no task sees a whole split.
    """
    features = [c for c in df.columns if c not in (*keys, time, value, label)]
    per_series = df.groupBy(label, *keys).agg(
        F.min(time).alias("_lo"), F.max(time).alias("_hi"), F.count(F.lit(1)).alias("_rows")
    )
    names = {f"num_{k}s": F.countDistinct(k) for k in keys}
    return per_series.groupBy(label).agg(
        F.min("_lo").alias("t_min"), F.max("_hi").alias("t_max"), F.sum("_rows").alias("dataset_size"),
        *[count.alias(name) for name, count in names.items()],
    ).withColumns({
        "y_features": F.array(F.lit(value)),
        "X_features": F.array(*[F.lit(c) for c in features]).cast("array<string>"),
    })


def score(pairs: DataFrame, by=(), actual: str = "y", forecast: str = "p") -> DataFrame:
    """RMSPE and MAPE, overall or per group of ``by``."""
    return pairs.groupBy(*by).agg(
        rmspe(actual, forecast).alias("RMSPE"), mape(actual, forecast).alias("MAPE")
    )


def score_slices(pairs: DataFrame, keys=KEYS, actual: str = "y", forecast: str = "p") -> DataFrame:
    """Per-series and overall RMSPE and MAPE from one pass; the overall row has NULL keys.

    Rows shrink to one (sum, sum of squares, count) triple per series, and only those triples are
    rolled up.
    """
    error = absolute_percentage_error(actual, forecast)
    sums = pairs.groupBy(*keys).agg(
        F.sum(error).alias("_s"), F.sum(error * error).alias("_q"), F.count(error).alias("_n")
    )
    overall = F.grouping_id(*keys) > 0
    return (
        sums.groupingSets([list(keys), []], *keys)
        .agg(
            F.sqrt(F.sum("_q") / F.sum("_n")).alias("RMSPE"),
            (F.sum("_s") / F.sum("_n")).alias("MAPE"),
            overall.alias("overall"),
        )
    )


def mape_per_hour(pairs: DataFrame, time: str = TIME, actual: str = "y", forecast: str = "p") -> DataFrame:
    """Unweighted mean over the series of each hour."""
    return pairs.groupBy(time).agg(mape(actual, forecast).alias("MAPE"))


def mean_over_folds(results: DataFrame, config: str = "config_id", measures=("MAPE",)) -> DataFrame:
    return results.groupBy(config).agg(*[F.avg(m).alias(m) for m in measures])


def best_config(means: DataFrame, config: str = "config_id", measure: str = "MAPE", digits: int = 12) -> DataFrame:
    """The row with the smallest measure; the smallest config breaks a tie.

    Measures that agree to ``digits`` decimals are ties, so the last bit of a sum does not decide.
    """
    rest = [c for c in means.columns if c != config]
    order = F.struct(F.round(measure, digits), F.col(config))
    return means.agg(F.min_by(F.struct(config, *rest), order).alias("best")).select("best.*")


def page_of(time: str = TIME, page_hours: int = PAGE_HOURS) -> Column:
    """The page of an hour, counted from the epoch: the same for every table and for ever."""
    return F.floor(epoch_hour(time) / page_hours).cast("int")


def page_index(paged: DataFrame, keys=KEYS, time: str = TIME) -> DataFrame:
    """Per series and page its first hour, its rows and the rows of earlier pages: where the n-th row of a series is."""
    earlier = Window.partitionBy(*keys).orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    counted = paged.select(*keys, "page", F.element_at(time, 1).alias("first_hour"), F.size(time).cast("long").alias("rows"))
    return counted.withColumn("offset", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))


def pages(
    df: DataFrame, keys=KEYS, time: str = TIME, values=(VALUE,), page_hours: int = PAGE_HOURS,
    names: dict | None = None,
) -> DataFrame:
    """Each series as parallel arrays in time order, cut into pages of ``page_hours`` hours.

    A page bounds the list a task builds, however long the series. Pages are counted from the epoch (``page_of``), so an hour
    stays on its page when others come or go, and the table is read once. Hours become epoch hours.
    """
    names = names or {}
    hour = epoch_hour(time)
    listed = F.array_sort(F.collect_list(F.struct(hour.alias("t"), *[F.col(v) for v in values])))
    return (
        df.withColumn("page", page_of(time, page_hours))
        .groupBy(*keys, "page").agg(listed.alias("_list"))
        .select(
            *keys, "page", field_of("_list", "t").alias(names.get(time, time)),
            *[field_of("_list", v).alias(names.get(v, v)) for v in values],
        )
    )


def label_splits(splits: dict[str, DataFrame], label: str = "split") -> DataFrame:
    """Union of named splits with their name in a column."""
    return reduce(DataFrame.unionByName, [df.withColumn(label, F.lit(name)) for name, df in splits.items()])


def series_by_split(
    labelled: DataFrame, splits, keys=KEYS, time: str = TIME, value: str = VALUE,
    label: str = "split", page_hours: int = PAGE_HOURS,
) -> DataFrame:
    """One row per series and page with the values of each split as an ordered array."""
    grouped = labelled.withColumn("page", page_of(time, page_hours)).groupBy(*keys, "page")
    # A row of another split is NULL, which the lists skip, so all lists together hold each row once.
    listed = {
        s: F.array_sort(F.collect_list(F.when(F.col(label) == s, F.struct(F.col(time).alias("t"), F.col(value).alias("v")))))
        for s in splits
    }
    return grouped.agg(*[column.alias(f"_{s}") for s, column in listed.items()]).select(
        *keys, "page", *[field_of(f"_{s}", "v").alias(s) for s in splits]
    )
