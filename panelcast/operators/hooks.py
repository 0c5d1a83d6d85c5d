"""Extension points for user code, always on Arrow batches or bounded groups."""

from __future__ import annotations

import math
import pickle
import struct
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from panelcast.operators.timeseries import newest
from panelcast.schemas import KEYS, TIME, VALUE

# Groups whose states a task holds before it passes them on.
MOST_GROUPS = 50_000
FORECAST_SCHEMA = "area tinyint, consumer_type int, datetime_utc timestamp_ntz, energy_consumption double"


def pointwise(function: Callable[[pd.Series, pd.Series], pd.Series], actual="y", forecast="p") -> Column:
    """A user's error function of (actual, forecast) batches as a column.

    Wrap it in a built-in aggregate (``F.avg``) to get a metric: partial aggregation still happens
    before the shuffle, and no group is handed to Python whole.
    """
    # Plain closures, so the workers need no import of this package.
    def score(y: pd.Series, p: pd.Series) -> pd.Series:
        return function(y, p)

    score.__annotations__ = {"y": pd.Series, "p": pd.Series, "return": pd.Series}
    return F.pandas_udf(score, "double")(actual, forecast)


class UserAggregate:
    """A user's aggregate over a group, in three steps, so that no group is ever handed over whole.

    ``partial`` turns some rows of a group, a pandas frame, into a state; ``merge`` joins two states of a group, in any
    order and grouping; ``finish`` gives the result of a group's whole state as a tuple in the order of ``result``, a DDL
    schema. States are bytes, and should not grow with the rows.
    """

    result = "value double"

    def partial(self, rows: pd.DataFrame) -> bytes:
        raise NotImplementedError

    def merge(self, first: bytes, second: bytes) -> bytes:
        raise NotImplementedError

    def finish(self, state: bytes) -> tuple:
        raise NotImplementedError


class GroupMean(UserAggregate):
    """The mean of a user's error of (actual, forecast) frames, as ``group.apply(error)`` gives it for a group in memory."""

    def __init__(self, error: Callable[[pd.DataFrame], pd.Series], name: str = "value"):
        self.error, self.result = error, f"{name} double"

    def partial(self, rows: pd.DataFrame) -> bytes:
        values = self.error(rows).dropna()
        return struct.pack("<dq", float(values.sum()), len(values))

    def merge(self, first: bytes, second: bytes) -> bytes:
        a, b = struct.unpack("<dq", first), struct.unpack("<dq", second)
        return struct.pack("<dq", a[0] + b[0], a[1] + b[1])

    def finish(self, state: bytes) -> tuple:
        total, n = struct.unpack("<dq", state)
        return (total / n if n else None,)


class GroupQuantile(UserAggregate):
    """A quantile of a column to a relative accuracy: values are counted in buckets that grow by a constant factor.

    The counts do not depend on how rows are dealt. Values of both signs and zero have their own buckets; their number grows
    with the logarithm of the values' range. Null and non-finite values do not count.
    """

    def __init__(self, column: str, quantile: float = 0.5, accuracy: float = 0.01, name: str = "value"):
        self.column, self.quantile, self.result = column, quantile, f"{name} double"
        self.growth = (1 + accuracy) / (1 - accuracy)

    def partial(self, rows: pd.DataFrame) -> bytes:
        values = rows[self.column].to_numpy(dtype=float)
        values = values[np.isfinite(values)]
        sizes = np.abs(values)
        steps = np.zeros(len(values))
        np.ceil(np.log(sizes, out=steps, where=sizes > 0) / math.log(self.growth), out=steps)
        signs = np.sign(values).astype(int)
        counted = Counter(zip(signs.tolist(), np.where(signs == 0, 0, steps).astype(int).tolist()))
        return pickle.dumps(dict(counted))

    def merge(self, first: bytes, second: bytes) -> bytes:
        return pickle.dumps(dict(Counter(pickle.loads(first)) + Counter(pickle.loads(second))))

    def finish(self, state: bytes) -> tuple:
        counts = pickle.loads(state)
        middle = lambda sign, step: sign * 2 * self.growth ** step / (self.growth + 1)
        ordered = sorted(counts, key=lambda k: (k[0], k[0] * k[1]))
        rank, seen = self.quantile * (sum(counts.values()) - 1), 0
        for sign, step in ordered:
            seen += counts[sign, step]
            if seen > rank:
                return (middle(sign, step) if sign else 0.0,)
        return (None,)


def aggregate_by(df: DataFrame, keys, aggregate: UserAggregate, columns, fan_in: int = 64) -> DataFrame:
    """A user's aggregate over the ``columns`` of every group of ``keys``.

    Each task reduces its rows to one state per group before anything is shuffled, and states meet ``fan_in`` tasks at a
    time, so a group that holds a third of all rows is as many states as there are tasks, merged in two levels. Null keys
    are a group; an empty table gives no rows.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    keys, columns = list(keys), list(columns)
    key_fields = [df.schema[k] for k in keys]
    # Plain values, so the workers need no import of this package beyond the aggregate's own class.
    states = T.StructType([*key_fields, T.StructField("_part", T.LongType()), T.StructField("_state", T.BinaryType())])
    done = T.StructType([*key_fields, *T.StructType.fromDDL(aggregate.result).fields])
    arrow = to_arrow_schema(states)
    done_arrow = to_arrow_schema(done)

    def encoded(found: dict, part: int) -> pa.RecordBatch:
        rows = [{**dict(zip(keys, k)), "_part": part, "_state": v} for k, v in found.items()]
        return pa.RecordBatch.from_pylist(rows, schema=arrow)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, found = TaskContext.get().partitionId(), {}
        for batch in batches:
            ids = pa.Table.from_batches([batch]).select(keys).to_pylist()
            groups: dict[tuple, list[int]] = {}
            for i, row in enumerate(ids):
                groups.setdefault(tuple(row.values()), []).append(i)
            rows = batch.select(columns).to_pandas()
            for key, at in groups.items():
                state = aggregate.partial(rows.iloc[at])
                found[key] = aggregate.merge(found[key], state) if key in found else state
            if len(found) > MOST_GROUPS:
                yield encoded(found, part)
                found = {}
        yield encoded(found, part)

    def merged(table: pa.Table) -> pa.Table:
        rows = table.sort_by("_part").to_pylist()
        state = rows[0]["_state"]
        for row in rows[1:]:
            state = aggregate.merge(state, row["_state"])
        return pa.Table.from_pylist([{**{k: rows[0][k] for k in keys}, "_part": rows[0]["_part"] // fan_in, "_state": state}], schema=arrow)

    def finished(table: pa.Table) -> pa.Table:
        row = merged(table).to_pylist()[0]
        values = aggregate.finish(row["_state"])
        names = done_arrow.names[len(keys):]
        return pa.Table.from_pylist([{**{k: row[k] for k in keys}, **dict(zip(names, values))}], schema=done_arrow)

    parts = df.select(*keys, *[c for c in columns if c not in keys]).mapInArrow(partial, states)
    grouped = parts.groupBy(*keys, F.floor(F.col("_part") / fan_in).alias("_group")).applyInArrow(merged, states)
    return grouped.groupBy(*keys).applyInArrow(finished, done)


def forecast_each(
    df: DataFrame, forecaster: Callable[[pd.DataFrame], pd.DataFrame], history_hours: int, keys=KEYS,
    time: str = TIME, value: str = VALUE, schema: str = FORECAST_SCHEMA,
) -> DataFrame:
    """Run a user's forecaster on the newest ``history_hours`` rows of each series.

    The caller states the look-back: it bounds what one call receives. The rank filter runs
    before the shuffle, so a hot series does not travel whole.
    """
    recent = newest(df.select(*keys, time, value), history_hours, keys, time)

    def call(rows: pd.DataFrame) -> pd.DataFrame:
        return forecaster(rows.sort_values(time))

    return recent.groupBy(*keys).applyInPandas(call, schema)


def rows_of(df: DataFrame, *arrays: str, keep=()) -> DataFrame:
    """Table function: parallel array columns become rows."""
    return df.select(*keep, F.inline(F.arrays_zip(*arrays)))
