"""Look-back features kept by day beside a feature table: an ingest makes anew only the days that its hours reach."""

from __future__ import annotations

import json
import math
from dataclasses import asdict, dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from panelcast.operators.features import WindowFeatures, depth_of
from panelcast.operators.timeseries import LAGS, MEAN_WINDOWS, STD_WINDOWS, calendar, look_back, window_columns
from panelcast.schemas import PANEL, TIME
from panelcast.sources.commits import Commit, commit, head
from panelcast.sources.feature_table import DAY, ROWS, _by_day, _write_days, layers_of

MADE_FROM, FOLDERS, DEFINITION = "made_from", "folders", "definition"


@dataclass(frozen=True)
class Features:
    """What is kept for a row. ``full`` keeps rows that have all their hours, with an array ``window`` as the forecaster's
    stages make it; otherwise all rows stay, with a column per lag and window that is NULL where an hour is missing."""

    lags: tuple = LAGS
    means: tuple = MEAN_WINDOWS
    stds: tuple = STD_WINDOWS
    with_calendar: bool = True
    full: bool = True

    @property
    def depth(self) -> int:
        return depth_of(self.lags, self.means, self.stds)

    @property
    def days_back(self) -> int:
        """Whole days before a day that its first hour looks into."""
        return math.ceil(self.depth / 24)

    def of(self, rows: DataFrame) -> DataFrame:
        if self.full:
            made = WindowFeatures(lags=self.lags, means=self.means, stds=self.stds).transform(rows)
        else:
            made = look_back(rows, window_columns(self.lags, self.means, self.stds), self.depth)
        return calendar(made) if self.with_calendar else made

    def schema(self, spark: SparkSession, schema: T.StructType) -> T.StructType:
        return self.of(spark.createDataFrame([], schema)).schema

    def text(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)


def store_path(table: str, name: str = "features") -> str:
    return f"{table.rstrip('/')}/{name}"


def _sources(stored: dict[str, list[str]], days_back: int) -> dict[str, list[str]]:
    """For each day the folders of the table that its features are made of: its own and those of the days before it."""
    def reached(day: str) -> list[str]:
        last = date.fromisoformat(day)
        return [f for back in range(days_back, -1, -1) for f in stored.get((last - timedelta(days=back)).isoformat(), [])]

    return {day: reached(day) for day in stored}


def _stale(stored: dict[str, list[str]], base: Commit, features: Features) -> list[str]:
    known = base.of(MADE_FROM) if base.of(DEFINITION).get("text") == [features.text()] else {}
    return sorted(day for day, sources in _sources(stored, features.days_back).items() if known.get(day) != sources)


def stale(spark: SparkSession, table: str, features: Features = Features(), name: str = "features") -> list[str]:
    """Days whose stored features are missing or older than the table's rows."""
    return _stale(head(spark, table).of(ROWS), head(spark, store_path(table, name)), features)


def refresh(
    spark: SparkSession, table: str, features: Features = Features(), schema: T.StructType = PANEL, name: str = "features",
) -> list[str]:
    """Make the features of all stale days; returns those days.

    A day names the folders it was made of, its own and those of the hours it looks back to. So a day that was ingested,
    corrected late, compacted or removed makes itself and the next ``days_back`` days stale, and only these are made again.
    Read are they and the days they look back to. Another definition makes all days stale. The new folders become visible
    in one commit; of two refreshes of the same days one is refused.
    """
    log = store_path(table, name)
    stored, base = head(spark, table).of(ROWS), head(spark, log)
    days = _stale(stored, base, features)
    gone = [d for d in base.of(MADE_FROM) if d not in stored]
    if not days and not gone:
        return []
    sources, written = _sources(stored, features.days_back), {}
    if days:
        ends = [date.fromisoformat(d) for d in days]
        near = {(d - timedelta(days=back)).isoformat() for d in ends for back in range(features.days_back + 1)}
        rows = layers_of(spark, {d: f for d, f in stored.items() if d in near}, schema)
        made = features.of(rows).withColumn(DAY, F.to_date(TIME))
        if near & set(stored) != set(days):
            made = made.filter(F.col(DAY).isin(ends))
        written = _write_days(spark, _by_day(made), log)
    commit(spark, log, base, {
        MADE_FROM: {**{d: sources[d] for d in days}, **dict.fromkeys(gone)},
        FOLDERS: {**{d: [written[d]] if d in written else None for d in days}, **dict.fromkeys(gone)},
        DEFINITION: {"text": [features.text()]},
    })
    return days


def read_features(
    spark: SparkSession, table: str, features: Features = Features(), first: str = "", last: str = "9999-12-31",
    schema: T.StructType = PANEL, name: str = "features",
) -> DataFrame:
    """The stored features of the days from ``first`` to ``last``; days outside are not even listed.

    Stale days are refused: a reader never gets features of rows that are no longer the table's.
    """
    stored, base = head(spark, table).of(ROWS), head(spark, store_path(table, name))
    old = [d for d in _stale(stored, base, features) if first <= d <= last]
    if old:
        raise RuntimeError(f"features of {len(old)} days of {table} are missing or old, from {old[0]} on; refresh them")
    folders = sorted(f for d, parts in base.of(FOLDERS).items() if first <= d <= last and d in stored for f in parts)
    shape = features.schema(spark, schema)
    return spark.read.schema(shape).parquet(*folders) if folders else spark.createDataFrame([], shape)
