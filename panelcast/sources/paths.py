"""Listing and removing dataset folders on any Hadoop file system."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    jvm_path, fs = _path(spark, path)
    return fs.exists(jvm_path)


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether a dataset folder holds anything but marker files."""
    jvm_path, fs = _path(spark, path)
    if not fs.exists(jvm_path):
        return False
    if not fs.getFileStatus(jvm_path).isDirectory():
        return True
    return any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(jvm_path))


def versions(spark: SparkSession, root: str, prefix: str = "v") -> list[int]:
    """Version numbers of the ``prefix=N`` folders below ``root``, ascending."""
    jvm_path, fs = _path(spark, root)
    if not fs.exists(jvm_path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(jvm_path) if s.isDirectory()]
    found = [re.fullmatch(rf"{prefix}=(\d+)", n) for n in names]
    return sorted(int(m.group(1)) for m in found if m)


def remove(spark: SparkSession, path: str) -> bool:
    jvm_path, fs = _path(spark, path)
    return fs.delete(jvm_path, True)
