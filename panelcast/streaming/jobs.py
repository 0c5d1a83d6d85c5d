"""Streams over landed files.

Event time columns are zone-free timestamps in the contract; a watermark needs an instant, so they
are cast to ``timestamp`` (session zone UTC) inside the stream and back at its end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from panelcast.functions.errors import absolute_percentage_error
from panelcast.operators.clean import clean
from panelcast.operators.quality import enforce, panel_suite
from panelcast.schemas import PANEL, RAW, ROW_KEYS, TIME, VALUE
from panelcast.sources import feature_store
from panelcast.sources.commits import commit, head, new_folder, sweep
from panelcast.sources.feature_table import upsert
from panelcast.sources.paths import _path

# A record may arrive the export length plus the publication delay after its hour.
ARRIVAL_LAG = "45 days"


def landed_stream(
    spark: SparkSession, path: str, schema: StructType, pattern: str | None = None, files_per_batch: int | None = None,
) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def start_ingest(
    spark: SparkSession, landing: str, table: str, checkpoint: str, schema: StructType = RAW,
    files_per_batch: int | None = None, policy: str = "fail", rejected: str | None = None, report: str | None = None,
    features: feature_store.Features | None = None,
) -> StreamingQuery:
    """Clean, validate and upsert each new set of landed files; with ``features`` bring the stored look-back features up to date.

    The upsert is keyed, so a batch that is replayed after a failure changes nothing. The batch is
    read and cleaned once; ``rejected`` and ``report`` are the tables of ``enforce``.
    """
    def write(batch: DataFrame, _: int) -> None:
        panel = batch.transform(clean).select(*PANEL.names).persist()
        try:
            upsert(batch.sparkSession, table, enforce(panel, panel_suite(panel), policy, rejected, report))
            if features is not None:
                feature_store.refresh(batch.sparkSession, table, features)
        finally:
            panel.unpersist()

    stream = landed_stream(spark, landing, schema, files_per_batch=files_per_batch)
    return (
        stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def with_instant(stream: DataFrame, delay: str, time: str = TIME) -> DataFrame:
    return stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)


def unique_rows(stream: DataFrame, on=ROW_KEYS, delay: str = ARRIVAL_LAG, time: str = TIME) -> DataFrame:
    """The first row of each (series, hour) within the arrival lag; the time stays an instant."""
    return with_instant(stream, delay, time).dropDuplicatesWithinWatermark(list(on))


def deduplicate(stream: DataFrame, on=ROW_KEYS, delay: str = ARRIVAL_LAG, time: str = TIME) -> DataFrame:
    return unique_rows(stream, on, delay, time).withColumn(time, F.col(time).cast("timestamp_ntz"))


def hourly_totals(
    events: DataFrame, keys, time: str = "ts", value: str = "value", delay: str = "1 hour", window: str = "1 hour",
) -> DataFrame:
    """Total per series and hour. In append mode an hour appears once the watermark passes its end.

    Values are summed as decimals, so the order of arrival does not change the result.
    """
    return (
        with_instant(events, delay, time)
        .groupBy(F.window(time, window).alias("_window"), *keys)
        .agg(F.sum(F.col(value).cast("decimal(18,2)")).cast("double").alias("total"))
        .select(
            F.col("_window.start").cast("timestamp_ntz").alias("hour"),
            F.col("_window.end").cast("timestamp_ntz").alias("hour_end"), *keys, "total",
        )
    )


def matched_errors(
    forecasts: DataFrame, truth: DataFrame, on=ROW_KEYS, delay: str = ARRIVAL_LAG, time: str = TIME, value: str = VALUE,
) -> DataFrame:
    """Stream-stream join of forecasts and late observations with the error of each match.

    The hour is part of the join key and carries the watermark on both sides, so state older than
    the arrival lag is dropped. Both sides are deduplicated first, because a repeated row would be
    matched again.
    """
    matched = _matched(forecasts, truth, on, delay, time, value)
    return matched.select(F.col(time).cast("timestamp_ntz").alias(time), "ape")


def _matched(forecasts: DataFrame, truth: DataFrame, on, delay: str, time: str, value: str) -> DataFrame:
    """Instant and error of each match; the instant carries the watermark on to what follows."""
    left = unique_rows(forecasts.select(*on, F.col(value).alias("p")), on, delay, time)
    right = unique_rows(truth.select(*on, F.col(value).alias("y")), on, delay, time)
    return left.join(right, list(on)).filter(F.col("y").isNotNull()).select(time, absolute_percentage_error("y", "p").alias("ape"))


def closed_scores(
    forecasts: DataFrame, truth: DataFrame, on=ROW_KEYS, delay: str = ARRIVAL_LAG, time: str = TIME, value: str = VALUE,
) -> DataFrame:
    """MAPE and matches of every hour, once, when no more rows of it can come.

    Deduplication, stream-stream join and windowed aggregate are one chain of stateful operators in append mode: the
    watermark of the slower side passes through the join, and an hour leaves the aggregate when it has passed its end. So
    scores need no partial results, and state is bounded by the arrival lag.
    """
    return (
        _matched(forecasts, truth, on, delay, time, value)
        .groupBy(F.window(time, "1 hour").alias("_window")).agg(F.avg("ape").alias("MAPE"), F.count("ape").alias("n"))
        .select(F.col("_window.start").cast("timestamp_ntz").alias(time), "MAPE", "n")
    )


def start_closed_scores(
    scores: DataFrame, root: str, checkpoint: str, most_folders: int = 8, time: str = TIME,
) -> StreamingQuery:
    """Store closed hours by day, exactly once, in a bounded number of folders.

    A batch's rows and its number become visible in one commit, so a batch that is replayed is skipped. When a day has more
    than ``most_folders`` folders they are written anew as one, and what no commit names any more is swept.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark, base = batch.sparkSession, head(batch.sparkSession, root)
        if int(base.of("batch").get("last", ["-1"])[0]) >= batch_id:
            return
        days = _scores_by_day(spark, batch, root, time)
        changes = {d: [*base.of("scores").get(d, []), folder] for d, folder in days.items()}
        commit(spark, root, base, {"scores": changes, "batch": {"last": [str(batch_id)]}})
        compact_scores(spark, root, most_folders, time)

    return (
        scores.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )


SCORES = f"{TIME} timestamp_ntz, MAPE double, n bigint"


def _scores_by_day(spark: SparkSession, rows: DataFrame, root: str, time: str) -> dict[str, str]:
    folder = new_folder(root, "scores")
    rows.withColumn("_day", F.date_format(time, "yyyy-MM-dd")).repartition("_day").write.partitionBy("_day").parquet(folder)
    jvm_path, fs = _path(spark, folder)
    names = [s.getPath().getName() for s in fs.listStatus(jvm_path) if s.isDirectory()]
    return {n.removeprefix("_day="): f"{folder}/{n}" for n in names if n.startswith("_day=")}


def compact_scores(spark: SparkSession, root: str, most_folders: int = 8, time: str = TIME) -> list[str]:
    """Write days with more than ``most_folders`` folders anew; returns those days. Readers keep the state they opened."""
    base = head(spark, root)
    large = {d: f for d, f in base.of("scores").items() if len(f) > most_folders}
    if large:
        rows = spark.read.schema(SCORES).parquet(*[f for folders in large.values() for f in folders])
        commit(spark, root, base, {"scores": {d: [f] for d, f in _scores_by_day(spark, rows, root, time).items()}})
        sweep(spark, root, keep_commits=2)
    return sorted(large)


def read_closed_scores(spark: SparkSession, root: str) -> DataFrame:
    folders = [f for day in head(spark, root).of("scores").values() for f in day]
    return spark.read.schema(SCORES).parquet(*folders) if folders else spark.createDataFrame([], SCORES)


def record_late_rows(spark: SparkSession, query: StreamingQuery, path: str) -> int:
    """Append, per batch, the rows that came behind the watermark and were dropped, by stateful operator; returns their sum.

    Call it when a run has ended. A run keeps the progress of its last ``spark.sql.streaming.numRecentProgressUpdates``
    batches, so that setting must cover a run.
    """
    rows = [(str(p["runId"]), int(p["batchId"]), i, op["operatorName"], int(op["numRowsDroppedByWatermark"]))
            for p in query.recentProgress for i, op in enumerate(p["stateOperators"])]
    late = [r for r in rows if r[4]]
    if late:
        table = spark.createDataFrame(late, "run string, batch long, operator int, name string, rows long")
        table.coalesce(1).write.mode("append").parquet(path)
    return sum(r[4] for r in late)


def start_scoring(errors: DataFrame, partials: str, checkpoint: str, time: str = TIME) -> StreamingQuery:
    """Append (hour, sum of errors, count) per batch.

    Observations of one hour may come in several batches, so only mergeable parts are stored. Each
    batch owns its partition and replaces it when it is replayed.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        parts = batch.groupBy(time).agg(F.sum("ape").alias("sum_ape"), F.count("ape").alias("n"))
        parts.write.mode("overwrite").parquet(f"{partials}/batch={batch_id}")

    return (
        errors.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def read_scores(spark: SparkSession, partials: str, time: str = TIME) -> DataFrame:
    """MAPE per hour from the stored parts."""
    schema = f"{time} timestamp_ntz, sum_ape double, n bigint, batch int"
    parts = spark.read.schema(schema).parquet(partials)
    return parts.groupBy(time).agg((F.sum("sum_ape") / F.sum("n")).alias("MAPE"))


def start_append(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a stream to a Parquet dataset, exactly once per checkpoint."""
    return (
        stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )
