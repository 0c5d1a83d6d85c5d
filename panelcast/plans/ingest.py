"""Landed records to a validated, documented feature table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from panelcast.operators.clean import clean
from panelcast.operators.quality import enforce, panel_suite
from panelcast.operators.statistics import describe_columns
from panelcast.operators.windows import export_metadata, export_window, require_complete
from panelcast.schemas import DATASET_END, DATASET_START, DAYS_DELAY, DAYS_EXPORT, PANEL, RAW_TIME_FORMAT, VALUE
from panelcast.sources import feature_store, table_statistics
from panelcast.sources.feature_table import create_view, read_table, table_path, upsert
from panelcast.sources.results import latest_run, record_run
from panelcast.sources.snapshots import write_snapshot

# Columns whose statistics are kept by day.
STATISTICS = ("area", "consumer_type", VALUE)

# The fields of the run records.
FEATURE_RUN = T.StructType([
    T.StructField("days_delay", T.IntegerType()),
    T.StructField("days_export", T.IntegerType()),
    T.StructField("url", T.StringType()),
    T.StructField("export_datetime_utc_start", T.StringType()),
    T.StructField("export_datetime_utc_end", T.StringType()),
    T.StructField("datetime_format", T.StringType()),
    T.StructField("num_unique_samples_per_time_series", T.LongType()),
    T.StructField("feature_group_version", T.IntegerType()),
])
VIEW_RUN = T.StructType([
    T.StructField("feature_view_version", T.IntegerType()),
    T.StructField("training_dataset_version", T.IntegerType()),
])


def in_window(raw: DataFrame, start: datetime, end: datetime, column: str = "HourUTC") -> DataFrame:
    """[start, end) on the landed hour text, which sorts like the time it spells."""
    text = "%Y-%m-%d %H:%M"
    return raw.filter((F.col(column) >= start.strftime(text)) & (F.col(column) < end.strftime(text)))


def run_ingest(
    spark: SparkSession, raw: DataFrame, root: str, reference: datetime | None = None,
    days_delay: int = DAYS_DELAY, days_export: int = DAYS_EXPORT, version: int = 1, source: str = "landed",
    dataset_start: datetime = DATASET_START, dataset_end: datetime = DATASET_END, policy: str = "fail",
    features: feature_store.Features | None = None,
) -> DataFrame:
    """Window, completeness, clean, validate, upsert; returns the run's record.

    The validation report is kept in ``validation``, statistics of the batch in ``statistics``, mergeable ones of the days it
    touched beside the table (``table_statistics``), and rows that a quarantine takes out in ``rejected``. With ``features``
    the look-back features of these days and of those after them that they reach are made anew (``feature_store``).
    """
    start, end = export_window(reference, days_delay, days_export, dataset_start, dataset_end)
    records = in_window(raw, start, end).persist()
    try:
        require_complete(records, days_export, "HourUTC")
        panel = records.transform(clean).select(*PANEL.names)
        base = root.rstrip("/")
        checked = enforce(panel, panel_suite(panel), policy, f"{base}/rejected", f"{base}/validation")
        upsert(spark, table_path(root, version), checked)
        summary = describe_columns(checked, (VALUE,)).withColumns({"version": F.lit(version), "computed_at": F.current_timestamp()})
        summary.coalesce(1).write.mode("append").parquet(f"{base}/statistics")
        table_statistics.refresh(spark, table_path(root, version), STATISTICS)
        if features is not None:
            feature_store.refresh(spark, table_path(root, version), features)
        run = export_metadata(records, start, end, source, days_delay, days_export, "HourUTC", RAW_TIME_FORMAT)
        record_run(run.withColumn("feature_group_version", F.lit(version)), root, "feature")
    finally:
        records.unpersist()
    return latest_run(spark, root, "feature", FEATURE_RUN)


def run_view(spark: SparkSession, root: str, start, end, name: str = "consumption", version: int = 1) -> DataFrame:
    """Save a view of the feature table and store its training snapshot; returns the run's record."""
    table = table_path(root, version)
    view_version = create_view(spark, root, name, table)
    write_snapshot(read_table(spark, table), f"{root}/{name}_v{view_version}", start, end)
    run = spark.createDataFrame([(view_version, 1)], VIEW_RUN)
    record_run(run, root, "view")
    return latest_run(spark, root, "view", VIEW_RUN)
