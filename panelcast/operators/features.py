"""Spark ML stages that turn an hourly panel into the vectors of a pooled regressor."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, functions as F

from panelcast.operators.clean import AttachKeys
from panelcast.operators.timeseries import (
    LAGS, MEAN_WINDOWS, STD_WINDOWS, calendar, full_history, hours_before, look_back,
)
from panelcast.schemas import KEYS, VALUE

CALENDAR = ("day_of_week", "hour_of_day")
KEY_FEATURES = tuple(f"{k}{AttachKeys.suffix}" for k in KEYS)


def depth_of(lags, means, stds) -> int:
    """Hours of history that the features reach back."""
    return max([*lags, *[s + n - 1 for s, n in (*means, *stds)]])


def other_features(config: dict) -> list[str]:
    """The calendar and key features of a configuration; both are on unless it says otherwise."""
    return [*(CALENDAR if config.get("calendar", True) else ()), *(KEY_FEATURES if config.get("keys", True) else ())]


def vector_size(lags, means, stds, others=(*CALENDAR, *KEY_FEATURES)) -> int:
    return len(lags) + len(means) + len(stds) + len(others)


def hours_of(past: Column, shift: int, length: int) -> Column:
    """The ``length`` values that end ``shift`` hours before the end of an oldest-first array."""
    return F.slice(past, -(shift + length - 1), length)


def sample_std(values: Column, length: int) -> Column:
    """Sample standard deviation of an array in one running pass."""
    start = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def step(acc: Column, x: Column) -> Column:
        n = acc["n"] + 1.0
        mean = acc["mean"] + (x - acc["mean"]) / n
        return F.struct(
            n.alias("n"), mean.alias("mean"),
            (acc["m2"] + (x - acc["mean"]) * (x - mean)).alias("m2"),
        )

    return F.aggregate(values, start, step, lambda acc: F.sqrt(acc["m2"] / (length - 1)))


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, b: a + b)


def window_values(past: Column, lags, means, stds) -> Column:
    """Lags, rolling means and rolling standard deviations of a history array, as one array."""
    return F.array(
        *[F.element_at(past, -k) for k in lags],
        *[total(hours_of(past, s, n)) / n for s, n in means],
        *[sample_std(hours_of(past, s, n), n) for s, n in stds],
    )


class CalendarFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds day of week (Monday 0) and hour of day; other columns are kept."""

    @keyword_only
    def __init__(self):
        super().__init__()

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return calendar(dataset)


class WindowFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds look-back features of an hourly panel and drops rows without a full history."""

    lags = Param(Params._dummy(), "lags", "hours back")
    means = Param(Params._dummy(), "means", "(shift, length) windows of rolling means")
    stds = Param(Params._dummy(), "stds", "(shift, length) windows of rolling standard deviations")

    @keyword_only
    def __init__(self, lags=LAGS, means=MEAN_WINDOWS, stds=STD_WINDOWS):
        super().__init__()
        self._set(lags=list(lags), means=[list(w) for w in means], stds=[list(w) for w in stds])

    def settings(self) -> tuple[list, list, list]:
        return self.getOrDefault("lags"), self.getOrDefault("means"), self.getOrDefault("stds")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        lags, means, stds = self.settings()
        depth = depth_of(lags, means, stds)
        # One Window operator gives the lags as an array and the rolling statistics as columns; a
        # full history implies that every shorter window is full.
        columns = {"history": F.collect_list(VALUE).over(hours_before(1, depth))}
        columns.update({f"_mean{i}": F.avg(VALUE).over(hours_before(s, s + n - 1)) for i, (s, n) in enumerate(means)})
        columns.update({f"_std{i}": F.stddev_samp(VALUE).over(hours_before(s, s + n - 1)) for i, (s, n) in enumerate(stds)})
        ready = look_back(dataset, columns, depth).transform(full_history, depth)
        parts = [f"element_at(history, -{k})" for k in lags]
        parts += [f"_mean{i}" for i in range(len(means))] + [f"_std{i}" for i in range(len(stds))]
        # One text expression: building it from 80 column objects takes the driver over a second.
        window = F.expr(f"array({', '.join(parts)})")
        return ready.withColumn("window", window).drop(*columns)


class FeatureVector(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Collects window, calendar and key features into the vector ``features``.

    ``size`` declares the vector's length in the schema, so fitting needs no extra job to look at a row.
    """

    size = Param(Params._dummy(), "size", "length of the vector")
    others = Param(Params._dummy(), "others", "columns after the windows")

    @keyword_only
    def __init__(self, size=0, others=(*CALENDAR, *KEY_FEATURES)):
        super().__init__()
        self._set(size=size, others=list(others))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        vectors = dataset.withColumn("features", feature_vector(self.getOrDefault("others"))).drop("window")
        return vectors.withMetadata("features", {"ml_attr": {"num_attrs": self.getOrDefault("size")}})


def feature_vector(others=(*CALENDAR, *KEY_FEATURES)) -> Column:
    if not others:
        return array_to_vector(F.col("window"))
    return array_to_vector(F.concat(F.col("window"), F.array(*[F.col(c).cast("double") for c in others])))
