"""Training snapshots: an event-time slice stored as delimited text under a version."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelcast.operators.windows import between_hours
from panelcast.schemas import PANEL


def snapshot_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/td_version={version}"


def write_snapshot(view: DataFrame, root: str, start, end, version: int = 1) -> str:
    """Store [start, end) of a view; the file count follows the data, nothing is coalesced."""
    path = snapshot_path(root, version)
    between_hours(view, start, end).write.mode("overwrite").option("header", True).csv(path)
    return path


def read_snapshot(spark: SparkSession, root: str, version: int = 1) -> DataFrame:
    return (
        spark.read.schema(PANEL).option("header", True).option("enforceSchema", False)
        .option("mode", "FAILFAST").csv(snapshot_path(root, version))
    )
