"""Tables written between steps, in the folder all executors share."""

from __future__ import annotations

import tempfile
import threading
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from panelcast.session import scratch_path

_STAGED: list[str] = []
_SHIPPED: set[str] = set()
_OPEN = threading.local()


def ship(spark: SparkSession) -> None:
    """Send this package's code to the workers, once per application.

    Functions that run in tasks import it there; this way it need not be installed on the executors or be
    on their path. Spark fetches the archive from the driver, so the folder it is made in may be local.
    """
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parent.parent
        archive = Path(tempfile.mkdtemp(prefix="panelcast-")) / "panelcast.zip"
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as packed:
            for source in sorted(package.rglob("*.py")):
                packed.write(source, source.relative_to(package.parent))
        context.addPyFile(str(archive))
        _SHIPPED.add(context.applicationId)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared scratch folder and read it back.

    This cuts the lineage: a lost executor repeats the tasks after the table, never those before it. The
    tables stay until ``clear_staged`` or until the driver's JVM ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)
    _STAGED.append(path)
    for scope in getattr(_OPEN, "scopes", []):
        scope.paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


class Temporary:
    """Tables staged inside this context, by this thread, go at its end, but for the one that is kept.

    What is kept must be a staged table, so nothing reads the others any more.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths, self.kept = spark, [], set()

    def __enter__(self) -> "Temporary":
        _OPEN.scopes = [*getattr(_OPEN, "scopes", []), self]
        return self

    def keep(self, table: DataFrame) -> DataFrame:
        """``table``, which was the last to be staged."""
        self.kept.add(self.paths[-1])
        return table

    def __exit__(self, *_) -> None:
        _OPEN.scopes = [s for s in _OPEN.scopes if s is not self]
        for path in self.paths:
            if path not in self.kept and path in _STAGED:
                _STAGED.remove(path)
                jvm_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
                jvm_path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def clear_staged(spark: SparkSession) -> None:
    """Remove all staged tables; results that still read them must have been written before."""
    while _STAGED:
        jvm_path = spark._jvm.org.apache.hadoop.fs.Path(_STAGED.pop())
        jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` does not have, for helpers beside a user's columns; Spark compares names without case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name in taken:
            name += "_"
        taken.add(name)
        out.append(name)
    return out
