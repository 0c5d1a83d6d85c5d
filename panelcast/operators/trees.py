"""Boosted trees as flat arrays, so that a recursion of forecasts is one narrow pass."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import SparkSession, functions as F

from panelcast.session import scratch_path
from panelcast.sources.paths import remove

#: Trees that are followed at once: bounds what a batch of rows takes in memory.
TREES_AT_ONCE = 64


@dataclass(frozen=True)
class FlatTrees:
    """A weighted sum of regression trees. Nodes of all trees are numbered together; a leaf has feature -1.

    A row goes left where its feature is at most the threshold.
    """

    roots: np.ndarray
    weights: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    @staticmethod
    def of_nodes(trees: Sequence[tuple[float, dict]]) -> "FlatTrees":
        """From (weight, tree) pairs; a tree is a number, or a dict of ``feature``, ``at_most``, ``then`` and ``other`` trees."""
        nodes: list[list] = []

        def add(tree) -> int:
            at = len(nodes)
            nodes.append([-1, 0.0, at, at, 0.0])
            if isinstance(tree, dict):
                nodes[at] = [tree["feature"], float(tree["at_most"]), add(tree["then"]), add(tree["other"]), 0.0]
            else:
                nodes[at][4] = float(tree)
            return at

        roots = [add(tree) for _, tree in trees]
        columns = list(zip(*nodes)) if nodes else [[]] * 5
        return FlatTrees(np.array(roots, np.int64), np.array([float(w) for w, _ in trees]), np.array(columns[0], np.int64), np.array(columns[1], float),
                         np.array(columns[2], np.int64), np.array(columns[3], np.int64), np.array(columns[4], float))

    @staticmethod
    def of_model(spark: SparkSession, model) -> "FlatTrees":
        """From a fitted ``GBTRegressionModel``, read from the form Spark saves it in: one job, whatever the number of nodes."""
        path = scratch_path(spark, "trees")
        model.write().save(path)
        try:
            node = F.col("nodeData")
            rows = spark.read.parquet(f"{path}/data").select(
                "treeID", node["id"].alias("id"), node["split"]["featureIndex"].alias("feature"), F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
                node["split"]["numCategories"].alias("categories"), node["leftChild"].alias("left"), node["rightChild"].alias("right"), node["prediction"].alias("value"),
            ).orderBy("treeID", "id").toPandas()
        finally:
            remove(spark, path)
        if (rows["categories"] >= 0).any():
            raise ValueError("categorical splits are not supported")
        place = {key: i for i, key in enumerate(zip(rows["treeID"], rows["id"]))}
        leaf = rows["left"].to_numpy() < 0
        child = lambda side: np.array([i if is_leaf else place[tree, at] for i, (tree, at, is_leaf) in enumerate(zip(rows["treeID"], rows[side], leaf))], np.int64)
        return FlatTrees(
            np.array([place[t, 0] for t in range(len(model.treeWeights))], np.int64), np.array(model.treeWeights, float),
            np.where(leaf, -1, rows["feature"].to_numpy()).astype(np.int64), rows["threshold"].fillna(0.0).to_numpy(float),
            child("left"), child("right"), rows["value"].to_numpy(float))

    def predict(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x))
        row = np.arange(len(x))[:, None]
        for first in range(0, len(self.roots), TREES_AT_ONCE):
            at = np.broadcast_to(self.roots[first:first + TREES_AT_ONCE], (len(x), len(self.roots[first:first + TREES_AT_ONCE]))).copy()
            while True:
                feature = self.feature[at]
                inner = feature >= 0
                if not inner.any():
                    break
                goes_left = x[row, np.maximum(feature, 0)] <= self.threshold[at]
                at = np.where(inner, np.where(goes_left, self.left[at], self.right[at]), at)
            out += self.value[at] @ self.weights[first:first + TREES_AT_ONCE]
        return out
