"""Versioned store of fitted Spark ML models with their metrics."""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from panelcast.sources.commits import claim, head, new_folder, retain

MODEL_METRICS = "version int, model string, RMSPE double, MAPE double"


def register_model(
    spark: SparkSession, model: PipelineModel, metrics: DataFrame, root: str, name: str, config: dict | None = None, slices: DataFrame | None = None,
) -> int:
    """Save a model with its (RMSPE, MAPE) row and commit both as the next version; returns the version.

    Its configuration and the errors of all slices stay with it, too. Writers that register at once get versions of their
    own, and a version that is listed can be loaded.
    """
    folder = new_folder(root, name)
    model.write().save(f"{folder}/model")
    metrics.select("RMSPE", "MAPE").coalesce(1).write.json(f"{folder}/metrics")
    spark.createDataFrame([(json.dumps(config or {}),)], "value string").coalesce(1).write.text(f"{folder}/config")
    if slices is not None:
        slices.write.parquet(f"{folder}/slices")
    return claim(spark, root, name, lambda _: [folder])


def load_model(spark: SparkSession, root: str, name: str, version: int | None = None) -> PipelineModel:
    """A stored version, by default the newest."""
    return PipelineModel.load(f"{_folder(spark, root, name, version)}/model")


def _folder(spark: SparkSession, root: str, name: str, version: int | None) -> str:
    found = head(spark, root).of(name)
    chosen = version if version is not None else max(map(int, found), default=None)
    if str(chosen) not in found:
        raise LookupError(f"no version {chosen} of model {name}")
    return found[str(chosen)][0]


def model_config(spark: SparkSession, root: str, name: str, version: int | None = None) -> dict:
    """The settings a version was registered with, by default those of the newest."""
    return json.loads(spark.read.text(f"{_folder(spark, root, name, version)}/config").first()[0])


def model_slices(spark: SparkSession, root: str, name: str, version: int | None = None) -> DataFrame:
    """The errors of every slice that a version was registered with."""
    return spark.read.parquet(f"{_folder(spark, root, name, version)}/slices")


def model_versions(spark: SparkSession, root: str) -> DataFrame:
    """One row per registered version of every model: its version, name and metrics."""
    listed = [(int(v), name, folders[0]) for name, parts in head(spark, root).parts.items() for v, folders in parts.items()]
    if not listed:
        return spark.createDataFrame([], MODEL_METRICS)
    scores = spark.read.schema("RMSPE double, MAPE double").json([f"{folder}/metrics" for _, _, folder in listed])
    at = F.regexp_extract(F.col("_metadata.file_path"), "/data/([^/]+)/metrics/", 1)
    known = spark.createDataFrame([(v, n, folder.rsplit("/", 1)[1]) for v, n, folder in listed], "version int, model string, folder string")
    return scores.withColumn("folder", at).join(known, "folder").select("version", "model", "RMSPE", "MAPE")


def drop_old_models(spark: SparkSession, root: str, keep: int, name: str | None = None) -> dict[str, list[int]]:
    """Take all but the newest ``keep`` versions off the list, with their metrics; ``sweep`` removes their files."""
    return retain(spark, root, keep, None if name is None else {name})
