"""Linear fits from mergeable second moments: one pass over the rows serves every penalty, fold and subset of features."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

#: Partial states that one task merges.
FAN_IN = 256

STATE = pa.schema([("segment", pa.int32()), ("part", pa.int64()), ("n", pa.float64()), ("mean", pa.binary()), ("scatter", pa.binary())])
STATE_DDL = "segment int, part long, n double, mean binary, scatter binary"


@dataclass(frozen=True)
class Moments:
    """Count, means, and sums of products about the means; the last column is the target.

    Sums about the means lose no digits to large levels, and two states merge exactly into that of all their rows.
    """

    n: float
    mean: np.ndarray
    scatter: np.ndarray

    @staticmethod
    def none(width: int) -> "Moments":
        return Moments(0.0, np.zeros(width), np.zeros((width, width)))

    @staticmethod
    def of(rows: np.ndarray) -> "Moments":
        if not len(rows):
            return Moments.none(rows.shape[1])
        mean = rows.mean(axis=0)
        about = rows - mean
        return Moments(float(len(rows)), mean, about.T @ about)

    def merge(self, other: "Moments") -> "Moments":
        n = self.n + other.n
        if not n:
            return self
        gap = other.mean - self.mean
        return Moments(n, self.mean + gap * (other.n / n), self.scatter + other.scatter + np.outer(gap, gap) * (self.n * other.n / n))

    def only(self, features: Sequence[int]) -> "Moments":
        """The state of some of the features, in this order, with the target."""
        at = [*features, len(self.mean) - 1]
        return Moments(self.n, self.mean[at], self.scatter[np.ix_(at, at)])

    def ridge(self, penalty: float) -> tuple[np.ndarray, float]:
        """Coefficients and intercept of least squares with an L2 penalty on the features in units of their deviations.

        The penalty counts in units of the target's deviation, as Spark's linear regression has it. A feature without
        variation gets 0; equations that a penalty of 0 leaves singular get their solution of least norm.
        """
        width = len(self.mean) - 1
        spread = np.sqrt(np.diag(self.scatter) / self.n) if self.n else np.zeros(width + 1)
        coefficients = np.zeros(width)
        varies = np.flatnonzero(spread[:width] > 0)
        if len(varies) and spread[width] > 0:
            scale = spread[varies]
            gram = self.scatter[np.ix_(varies, varies)] / self.n / np.outer(scale, scale)
            right = self.scatter[varies, width] / self.n / scale / spread[width]
            gram[np.diag_indices_from(gram)] += penalty / spread[width]
            try:
                solved = np.linalg.solve(gram, right)
            except np.linalg.LinAlgError:
                solved = np.linalg.lstsq(gram, right, rcond=None)[0]
            coefficients[varies] = solved * spread[width] / scale
        return coefficients, float(self.mean[width] - self.mean[:width] @ coefficients)

    def gradient(self, coefficients: np.ndarray, penalty: float) -> np.ndarray:
        """How far coefficients are from solving the equations, per feature in units of deviations; 0 at the solution."""
        width = len(self.mean) - 1
        spread = np.sqrt(np.diag(self.scatter) / self.n)
        scale, unit = np.where(spread[:width] > 0, spread[:width], 1.0), spread[width] or 1.0
        covered = self.scatter[:width, width] - self.scatter[:width, :width] @ coefficients
        return covered / self.n / scale / unit - penalty / unit * coefficients * scale / unit


def moments(rows: DataFrame, segment: str, features: str, target: str, width: int) -> dict[int, Moments]:
    """The state of every segment: ``features`` is an array of ``width`` - 1 numbers, null segments are left out.

    A task gives one state per segment, whatever its rows; states are merged ``FAN_IN`` at a time, so what is shuffled
    depends on the tasks and not on the rows, and no key is hot. The driver gets one state per segment.
    """
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: dict[int, Moments] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            at = batch.column(0).to_numpy()
            x = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, width - 1)
            both = np.column_stack([x, batch.column(2).to_numpy()])
            for s in np.unique(at):
                states[int(s)] = states.get(int(s), Moments.none(width)).merge(Moments.of(both[at == s]))
        yield _encoded([(s, TaskContext.get().partitionId(), m) for s, m in states.items()])

    def merged(key: tuple, table: pa.Table) -> pa.Table:
        rows = sorted(_decoded(table), key=lambda r: r[1])
        total = Moments.none(width)
        for _, _, state in rows:
            total = total.merge(state)
        return pa.Table.from_batches([_encoded([(rows[0][0], rows[0][1] // FAN_IN, total)])])

    parts = (rows.where(F.col(segment).isNotNull()).select(F.col(segment).cast("int").alias("segment"), F.col(features).alias("x"), F.col(target).cast("double").alias("y"))
             .mapInArrow(partial, STATE_DDL))
    for _ in range(2):
        parts = parts.groupBy("segment", F.floor(F.col("part") / FAN_IN).alias("group")).applyInArrow(merged, STATE_DDL)
    out: dict[int, Moments] = {}
    for s, _, state in sorted(_decoded(parts.toArrow()), key=lambda r: r[:2]):
        out[s] = out.get(s, Moments.none(width)).merge(state)
    return out


def _encoded(rows: list[tuple[int, int, Moments]]) -> pa.RecordBatch:
    columns = [[r[0] for r in rows], [r[1] for r in rows], [r[2].n for r in rows], [r[2].mean.tobytes() for r in rows], [r[2].scatter.tobytes() for r in rows]]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, STATE)], schema=STATE)


def _decoded(table: pa.Table) -> list[tuple[int, int, Moments]]:
    out = []
    for r in table.to_pylist():
        mean = np.frombuffer(r["mean"])
        out.append((r["segment"], r["part"], Moments(r["n"], mean, np.frombuffer(r["scatter"]).reshape(len(mean), len(mean)))))
    return out
