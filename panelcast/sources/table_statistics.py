"""Statistics of a feature table, kept by day beside it: the whole table's come from its days' states, not from its rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from panelcast.operators.statistics import column_states, merged_correlations, merged_states, pair_states
from panelcast.schemas import PANEL, TIME
from panelcast.sources.commits import commit, head, new_folder
from panelcast.sources.feature_table import ROWS, layers_of
from panelcast.sources.paths import _path

KINDS = {"columns": column_states, "pairs": pair_states}


def _log(path: str) -> str:
    return f"{path.rstrip('/')}/statistics"


def refresh(spark: SparkSession, path: str, columns, schema: T.StructType = PANEL) -> list[str]:
    """Make the states of all days whose folders have changed since the last refresh; returns those days.

    A day's state names the folders it was made from, so days that were written again are made anew, and only those are read.
    """
    stored, base = head(spark, path).of(ROWS), head(spark, _log(path))
    made_from = base.of("made_from")
    changed = sorted(d for d, folders in stored.items() if made_from.get(d) != folders)
    gone = [d for d in made_from if d not in stored]
    if not changed and not gone:
        return []
    changes: dict = {"made_from": {**{d: stored[d] for d in changed}, **dict.fromkeys(gone)}}
    if changed:
        rows = layers_of(spark, {d: stored[d] for d in changed}, schema).withColumn("day", F.date_format(TIME, "yyyy-MM-dd")).persist()
        try:
            for kind, states in KINDS.items():
                folder = new_folder(_log(path), kind)
                states(rows, columns, ("day",)).repartition("day").write.partitionBy("day").parquet(folder)
                jvm_path, fs = _path(spark, folder)
                names = [s.getPath().getName() for s in fs.listStatus(jvm_path) if s.isDirectory()]
                changes[kind] = {**{n.removeprefix("day="): [f"{folder}/{n}"] for n in names if n.startswith("day=")}, **dict.fromkeys(gone)}
        finally:
            rows.unpersist()
    commit(spark, _log(path), base, changes)
    return changed


def _states(spark: SparkSession, path: str, kind: str) -> DataFrame:
    folders = [f for part in head(spark, _log(path)).of(kind).values() for f in part]
    if not folders:
        raise FileNotFoundError(f"no statistics of {path}")
    return spark.read.parquet(*sorted(folders))


def table_states(spark: SparkSession, path: str) -> DataFrame:
    """The merged state of every column of the whole table (see ``summarised`` and ``estimated_histogram``)."""
    return merged_states(_states(spark, path, "columns"))


def table_correlations(spark: SparkSession, path: str) -> DataFrame:
    return merged_correlations(_states(spark, path, "pairs"))
