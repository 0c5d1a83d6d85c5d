"""Published result tables and run records."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from panelcast.functions.hours import epoch_hour, from_epoch_hour
from panelcast.schemas import TIME
from panelcast.sources.commits import commit, head, new_folder
from panelcast.sources.paths import _path, has_data

WHOLE = "whole"


def encode_hours(df: DataFrame, time: str = TIME) -> DataFrame:
    """Stored form of the hour: hours since the epoch, as bigint."""
    return df.withColumn(time, epoch_hour(time))


def decode_hours(df: DataFrame, time: str = TIME) -> DataFrame:
    return df.withColumn(time, from_epoch_hour(time))


def _log(root: str) -> str:
    return f"{root.rstrip('/')}/published"


def publish(results: dict[str, DataFrame], root: str) -> dict[str, str]:
    """Replace each named dataset as a whole, all in one commit; hours are stored as epoch hours.

    Readers go on with the datasets they opened. A run that stops earlier leaves all of them as they were.
    """
    if not results:
        return {}
    spark = next(iter(results.values())).sparkSession
    base = head(spark, _log(root))
    folders = {name: new_folder(_log(root), name) for name in results}
    for name, df in results.items():
        (encode_hours(df) if TIME in df.columns else df).write.parquet(folders[name])
    commit(spark, _log(root), base, {n: {**dict.fromkeys(base.of(n)), WHOLE: [folder]} for n, folder in folders.items()})
    return folders


def read_published(spark: SparkSession, root: str, name: str, schema: T.StructType) -> DataFrame:
    """A published dataset with its hours decoded; empty when it was never published."""
    folders = [f for part in head(spark, _log(root)).of(name).values() for f in part]
    return _read(spark, folders, schema)


def _read(spark: SparkSession, folders: list[str], schema: T.StructType) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema)
    stored = T.StructType([
        T.StructField(f.name, T.LongType()) if f.name == TIME else f for f in schema.fields
    ])
    return decode_hours(spark.read.schema(stored).parquet(*sorted(folders)))


def update_days(
    spark: SparkSession, root: str, name: str, schema: T.StructType, incoming: DataFrame, start: Column, merge: Callable[[DataFrame, DataFrame], DataFrame],
) -> None:
    """Merge rows into a published dataset that is kept by day, in one commit.

    Only the days of ``incoming`` and the day of ``start`` are read and written; earlier days leave, all others stay
    as they are. ``merge`` gets the incoming rows and the stored ones of those days. A dataset that was published whole
    is read once more and kept by day from then on.
    """
    base = head(spark, _log(root))
    held = base.of(name)
    rows = incoming.persist()
    try:
        bound = spark.range(1).select(F.date_format(start, "yyyy-MM-dd")).first()[0]
        days = {r[0] for r in rows.select(F.date_format(TIME, "yyyy-MM-dd")).distinct().collect()} | {bound}
        touched = {d: f for d, f in held.items() if d in days or d == WHOLE}
        merged = merge(rows, _read(spark, [f for part in touched.values() for f in part], schema))
        folder = new_folder(_log(root), name)
        encode_hours(merged.withColumn("_day", F.date_format(TIME, "yyyy-MM-dd"))).repartition("_day").write.partitionBy("_day").parquet(folder)
    finally:
        rows.unpersist()
    jvm_path, fs = _path(spark, folder)
    written = [s.getPath().getName() for s in fs.listStatus(jvm_path) if s.isDirectory()]
    gone = {d: None for d in held if d in touched or d < bound}
    commit(spark, _log(root), base, {name: gone | {n.removeprefix("_day="): [f"{folder}/{n}"] for n in written if n.startswith("_day=")}})


def record_run(run: DataFrame, root: str, kind: str) -> None:
    """Append a one-row description of a run to the run records of its kind."""
    stamped = run.withColumn("run_ts", F.current_timestamp())
    stamped.coalesce(1).write.mode("append").json(f"{root.rstrip('/')}/run_metadata/kind={kind}")


def latest_run(spark: SparkSession, root: str, kind: str, schema: T.StructType) -> DataFrame:
    """The newest record of a kind; an error when there is none."""
    path = f"{root.rstrip('/')}/run_metadata/kind={kind}"
    if not has_data(spark, path):
        raise FileNotFoundError(f"no run record of kind {kind} below {root}")
    stored = T.StructType([*schema.fields, T.StructField("run_ts", T.TimestampType())])
    runs = spark.read.schema(stored).json(path)
    newest = F.max_by(F.struct(*schema.names), F.col("run_ts")).alias("run")
    return runs.agg(newest).select("run.*")
