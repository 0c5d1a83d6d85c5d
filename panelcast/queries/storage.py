"""A: scans, sources and sinks."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from panelcast import fixtures
from panelcast.functions.hours import epoch_hour, from_epoch_hour
from panelcast.operators import forecast as fc
from panelcast.operators import statistics
from panelcast.operators.aggregates import label_splits, score
from panelcast.operators.clean import split_target
from panelcast.operators.joins import merge_versions, overlay
from panelcast.operators.windows import between_hours, export_metadata
from panelcast.plans import training
from panelcast.plans.ingest import FEATURE_RUN
from panelcast.queries.registry import query, rounded
from panelcast.queries.sql import (
    CACHED, FIT_OF_TRAIN, FITTED_STEP, LAGGED, LINE, LINE_OF_TRAIN, NEW, RAW, TEST_FORECAST, ctes, dense_sql, panel_sql, recursion, recursive_sql,
)
from panelcast.schemas import COLUMN_DOCS, FORECAST, PANEL, ROW_KEYS
from panelcast.session import scratch_path
from panelcast.sources import commits, feature_table, landed, models, paths, results, snapshots, table_statistics

RANGE = (datetime(2024, 1, 10, 6), datetime(2024, 1, 20, 18))
RANGE_SQL = "datetime_utc >= timestamp '2024-01-10 06:00:00' and datetime_utc < timestamp '2024-01-20 18:00:00'"
ALL_PANEL = panel_sql("select datetime_utc, area, consumer_type, energy_consumption from panel")


def stored_panel(spark, sf_dir, name: str) -> str:
    path = scratch_path(spark, name)
    feature_table.upsert(spark, path, fixtures.panel(spark, sf_dir))
    return path


@query("a01_delimited_scan", ctes(RAW) + "select * from raw")
def a01(spark, sf_dir):
    path = scratch_path(spark, "landed-csv")
    fixtures.raw(spark, sf_dir).write.option("sep", ";").option("header", True).csv(path)
    return landed.require_rows(landed.read_delimited(spark, path), path)


def landed_payloads(spark, sf_dir) -> str:
    """One payload per day and series: at most 24 records each."""
    path = scratch_path(spark, "landed-json")
    raw = fixtures.raw(spark, sf_dir)
    (
        raw.groupBy(F.substring("HourUTC", 1, 10).alias("_day"), "PriceArea", "ConsumerType_DE35")
        .agg(F.collect_list(F.struct(*raw.columns)).alias("records"))
        .select("records").write.json(path)
    )
    return path


@query("a02_payload_scan", ctes(RAW) + "select * from raw")
def a02(spark, sf_dir):
    return landed.read_payloads(spark, landed_payloads(spark, sf_dir))


@query("a03_parquet_scan", ALL_PANEL)
def a03(spark, sf_dir):
    path = scratch_path(spark, "panel")
    fixtures.panel(spark, sf_dir).write.parquet(path)
    return landed.read_parquet(spark, path, PANEL)


@query("a04_missing_dataset_scan", panel_sql("select area, consumer_type, datetime_utc, energy_consumption from panel"))
def a04(spark, sf_dir):
    absent = landed.read_or_empty(spark, scratch_path(spark, "absent"), FORECAST)
    return overlay(merge_versions(fixtures.panel(spark, sf_dir), absent))


A05 = panel_sql("""
, first_day as (select cast(min(datetime_utc) as date) as d from panel),
incoming as (select datetime_utc, area, consumer_type, energy_consumption + 1 as energy_consumption
             from panel, first_day where datetime_utc >= d + interval 18 day),
stored as (select panel.* from panel, first_day where datetime_utc < d + interval 20 day)
select * from incoming
union all
select s.* from stored s anti join incoming i
  on s.datetime_utc = i.datetime_utc and s.area = i.area and s.consumer_type = i.consumer_type""")


@query("a05_keyed_upsert", A05)
def a05(spark, sf_dir):
    panel = fixtures.panel(spark, sf_dir)
    first = panel.agg(F.min(F.to_date("datetime_utc"))).scalar()
    stored = panel.filter(F.to_date("datetime_utc") < F.date_add(first, 20))
    incoming = panel.filter(F.to_date("datetime_utc") >= F.date_add(first, 18)).withColumn(
        "energy_consumption", F.col("energy_consumption") + 1
    )
    path = scratch_path(spark, "feature-table")
    feature_table.upsert(spark, path, stored)
    feature_table.upsert(spark, path, incoming)
    return feature_table.read_table(spark, path)


@query("a05b_layered_upsert", A05)
def a05b(spark, sf_dir):
    """The second batch as a layer on its days, read merged, then compacted, then swept: the rows stay the same."""
    panel = fixtures.panel(spark, sf_dir)
    first = panel.agg(F.min(F.to_date("datetime_utc"))).scalar()
    path = scratch_path(spark, "layered-table")
    feature_table.upsert(spark, path, panel.filter(F.to_date("datetime_utc") < F.date_add(first, 20)))
    late = panel.filter(F.to_date("datetime_utc") >= F.date_add(first, 18)).withColumn("energy_consumption", F.col("energy_consumption") + 1)
    feature_table.upsert(spark, path, late, merge=False)
    before = feature_table.read_table(spark, path).count()
    feature_table.compact(spark, path)
    commits.sweep(spark, path, older_than=0)
    after = feature_table.read_table(spark, path)
    return after.where(F.lit(before) == after.agg(F.count(F.lit(1))).scalar())


@query("a06_column_descriptions", panel_sql("\nunion all ".join(
    f"select '{name}' as name, '{text}' as description, count({name}) as non_null from panel"
    for name, text in COLUMN_DOCS.items()
)))
def a06(spark, sf_dir):
    return feature_table.descriptions(feature_table.describe(fixtures.panel(spark, sf_dir)))


NUMERIC = ("area", "consumer_type", "energy_consumption")


@query("a07_table_statistics", panel_sql("\nunion all ".join(
    f"""select '{c}' as "column", count({c}) as count, count(*) - count({c}) as nulls,
    cast(min({c}) as double) as min, cast(max({c}) as double) as max, round(avg({c}), 6) as mean,
    round(stddev_samp({c}), 6) as std, count(distinct {c}) as "distinct" from panel""" for c in NUMERIC
)))
def a07(spark, sf_dir):
    table = statistics.describe_columns(fixtures.panel(spark, sf_dir), NUMERIC, exact_distinct=True)
    return rounded(table, "mean", "std")


@query("a07b_histogram", panel_sql("""
, bounds as (select min(energy_consumption) as lo, max(energy_consumption) as hi from panel)
select cast(least(floor((energy_consumption - b.lo) * 20 / (b.hi - b.lo)), 19) as integer) as bin, count(*) as rows
from panel, bounds b group by 1"""))
def a07b(spark, sf_dir):
    return statistics.histogram(fixtures.panel(spark, sf_dir), "energy_consumption", 20)


@query("a07c_correlations", panel_sql("""
select 'area' as first, 'consumer_type' as second, round(corr(area, consumer_type), 6) as corr from panel union all
select 'area', 'energy_consumption', round(corr(area, energy_consumption), 6) from panel union all
select 'consumer_type', 'energy_consumption', round(corr(consumer_type, energy_consumption), 6) from panel"""))
def a07c(spark, sf_dir):
    return rounded(statistics.correlations(fixtures.panel(spark, sf_dir), NUMERIC), "corr")


@query("a07d_stored_statistics", panel_sql("\nunion all ".join(
    f"""select '{c}' as "column", count({c}) as count, count(*) - count({c}) as nulls, cast(min({c}) as double) as min,
    cast(max({c}) as double) as max, round(avg({c}), 6) as mean, round(stddev_samp({c}), 6) as std,
    true as distinct_within_5_percent, true as median_within_2_percent from panel""" for c in NUMERIC)))
def a07d(spark, sf_dir):
    """Statistics of a table from the states of its days, after a second batch that overlaps the first. What sketches
    estimate is compared with exact counts, within stated bounds."""
    path, panel = scratch_path(spark, "counted-table"), fixtures.panel(spark, sf_dir)
    middle = F.lit("2024-01-16").cast("timestamp_ntz")
    feature_table.upsert(spark, path, panel.filter(F.col("datetime_utc") < middle).withColumn("energy_consumption", F.col("energy_consumption") * 2))
    table_statistics.refresh(spark, path, NUMERIC)
    feature_table.upsert(spark, path, panel)
    table_statistics.refresh(spark, path, NUMERIC)
    found = statistics.summarised(table_statistics.table_states(spark, path))
    exact = statistics.describe_columns(panel, NUMERIC, exact_distinct=True).select("column", F.col("distinct").alias("exact"))
    medians = found.select(F.map_from_entries(F.collect_list(F.struct("column", "p50")))).scalar()
    below = panel.withColumn("_m", medians).agg(*[
        F.struct(F.avg((F.col(c) < F.col("_m")[c]).cast("double")).alias("lo"), F.avg((F.col(c) <= F.col("_m")[c]).cast("double")).alias("hi")).alias(c) for c in NUMERIC])
    ranks = below.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"{c}.lo").alias("lo"), F.col(f"{c}.hi").alias("hi")) for c in NUMERIC])))
    joined = found.join(exact, "column").join(ranks, "column")
    return rounded(joined, "mean", "std").select(
        "column", "count", "nulls", "min", "max", "mean", "std",
        (F.abs(F.col("distinct") - F.col("exact")) <= 0.05 * F.col("exact")).alias("distinct_within_5_percent"),
        ((F.col("lo") <= 0.52) & (F.col("hi") >= 0.48)).alias("median_within_2_percent"))


@query("a07e_stored_correlations", panel_sql("""
select 'area' as first, 'consumer_type' as second, round(corr(area, consumer_type), 6) as corr from panel union all
select 'area', 'energy_consumption', round(corr(area, energy_consumption), 6) from panel union all
select 'consumer_type', 'energy_consumption', round(corr(consumer_type, energy_consumption), 6) from panel"""))
def a07e(spark, sf_dir):
    path = stored_panel(spark, sf_dir, "correlated-table")
    table_statistics.refresh(spark, path, NUMERIC)
    return rounded(table_statistics.table_correlations(spark, path), "corr")


@query("a08_feature_view", ALL_PANEL)
def a08(spark, sf_dir):
    root = scratch_path(spark, "views")
    table = stored_panel(spark, sf_dir, "viewed-table")
    feature_table.create_view(spark, root, "consumption", table)
    version = feature_table.create_view(spark, root, "consumption", table)
    feature_table.open_view(spark, root, "consumption", version)
    return spark.sql(f"select * from consumption_v{version}")


def _snapshot(spark, sf_dir) -> str:
    root = scratch_path(spark, "snapshots")
    snapshots.write_snapshot(fixtures.panel(spark, sf_dir), root, *RANGE)
    return root


@query("a09_training_snapshot", panel_sql(f"""
select strftime(datetime_utc, '%Y-%m-%d') as day, count(*) as rows,
       cast(sum(cast(energy_consumption as decimal(18,2))) as double) as total
from panel where {RANGE_SQL} group by 1"""))
def a09(spark, sf_dir):
    stored = snapshots.read_snapshot(spark, _snapshot(spark, sf_dir))
    return stored.groupBy(F.date_format("datetime_utc", "yyyy-MM-dd").alias("day")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.col("energy_consumption").cast("decimal(18,2)")).cast("double").alias("total"),
    )


@query("a10_read_snapshot", panel_sql(f"select * from panel where {RANGE_SQL}"))
def a10(spark, sf_dir):
    return snapshots.read_snapshot(spark, _snapshot(spark, sf_dir))


@query("a11_range_read", panel_sql(f"select * from panel where {RANGE_SQL}"))
def a11(spark, sf_dir):
    return feature_table.read_range(spark, stored_panel(spark, sf_dir, "range-table"), *RANGE)


@query("a11b_closed_range_read", panel_sql(f"""
select * from panel where {RANGE_SQL} or datetime_utc = timestamp '2024-01-20 18:00:00'"""))
def a11b(spark, sf_dir):
    return feature_table.read_range(spark, stored_panel(spark, sf_dir, "range-table"), *RANGE, closed="both")


@query("a12_published_results", dense_sql("""
select 'X' as dataset, area, consumer_type, datetime_utc, cast(null as double) as energy_consumption from panel
union all select 'y', area, consumer_type, datetime_utc, energy_consumption from panel
union all select 'predictions', area, consumer_type, datetime_utc, energy_consumption from fresh""", NEW))
def a12(spark, sf_dir):
    root = scratch_path(spark, "published")
    panel = fixtures.panel(spark, sf_dir)
    exogenous, target = split_target(panel)
    forecasts = fixtures.new_forecasts(fixtures.dense(spark, sf_dir))
    empty = exogenous.withColumn("energy_consumption", F.lit(None).cast("double"))
    results.publish({"X": empty.select(*FORECAST.names), "y": target, "predictions": forecasts}, root)
    return label_splits(
        {n: results.read_published(spark, root, n, FORECAST) for n in ("X", "y", "predictions")}, "dataset"
    )


@query("a13_run_records", panel_sql(f"""
select 15 as days_delay, 30 as days_export, 'events' as url, '2024-01-10 06:00' as export_datetime_utc_start,
       '2024-01-20 18:00' as export_datetime_utc_end, 'yyyy-MM-dd HH:mm' as datetime_format,
       count(distinct datetime_utc) as num_unique_samples_per_time_series, 2 as feature_group_version
from panel where {RANGE_SQL}"""))
def a13(spark, sf_dir):
    root = scratch_path(spark, "runs")
    panel = fixtures.panel(spark, sf_dir)
    for version, start in ((1, datetime(2024, 1, 1)), (2, RANGE[0])):
        rows = between_hours(panel, start, RANGE[1])
        run = export_metadata(rows, start, RANGE[1], "events").withColumn("feature_group_version", F.lit(version))
        results.record_run(run, root, "feature")
    return results.latest_run(spark, root, "feature", FEATURE_RUN)


@query("a14_version_retention", panel_sql("""
, weeks as (
  select cast(floor(date_diff('hour', timestamp '1970-01-01', datetime_utc) / 168) as integer) as version,
         count(*) as rows from panel group by 1),
ranked as (select *, row_number() over (order by version desc) as r from weeks)
select 'panel' as name, version, rows, r > 2 as expired, case when r <= 2 then rows else 0 end as rows_left from ranked"""))
def a14(spark, sf_dir):
    root = scratch_path(spark, "versions")
    panel = fixtures.panel(spark, sf_dir)
    weekly = panel.withColumn("v", F.floor(epoch_hour("datetime_utc") / 168).cast("int"))
    weekly.repartition("v").write.partitionBy("v").parquet(root)
    listing = weekly.groupBy(F.lit("panel").alias("name"), F.col("v").alias("version")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    feature_table.drop_old_versions(spark, root, keep=2)
    left = (
        spark.read.parquet(*[feature_table.table_path(root, v) for v in paths.versions(spark, root)])
        .groupBy(F.floor(epoch_hour("datetime_utc") / 168).cast("int").alias("version"))
        .agg(F.count(F.lit(1)).alias("rows_left"))
    )
    return feature_table.mark_expired(listing, keep=2).join(left, "version", "left").select(
        "name", "version", "rows", "expired", F.coalesce("rows_left", F.lit(0)).cast("bigint").alias("rows_left")
    )


@query("a14b_sweep", panel_sql("""
select strftime(datetime_utc, '%Y-%m-%d') as day, count(*) as rows, cast(1 as bigint) as folders_left from panel group by 1"""))
def a14b(spark, sf_dir):
    """Days that are written again and again leave folders that no commit names; a sweep leaves one for each day."""
    panel = fixtures.panel(spark, sf_dir)
    path = scratch_path(spark, "swept-table")
    for kept in ("area = 0", "area < 2", "true"):
        feature_table.upsert(spark, path, panel.where(kept))
    commits.sweep(spark, path, older_than=0)
    jvm_path, fs = paths._path(spark, f"{path}/data")
    left = [day.getPath().getName() for batch in fs.listStatus(jvm_path) for day in fs.listStatus(batch.getPath()) if day.isDirectory()]
    on_disk = spark.createDataFrame([(n.removeprefix("day="),) for n in left], "day string").groupBy("day").agg(F.count(F.lit(1)).alias("folders_left"))
    rows = feature_table.read_table(spark, path).groupBy(F.date_format("datetime_utc", "yyyy-MM-dd").alias("day")).agg(F.count(F.lit(1)).alias("rows"))
    return rows.join(on_disk, "day")


def _registered(spark, sf_dir, config):
    root = scratch_path(spark, "models")
    train, test = training.split(fixtures.dense(spark, sf_dir))
    model = fc.fit(train, config)
    scores = score(fc.evaluate(model, train, test))
    models.register_model(spark, model, scores, root, "best_model")
    models.register_model(spark, model, scores, root, "best_model")
    newest = models.load_model(spark, root, "best_model")
    versions = models.model_versions(spark, root).agg(F.max("version")).scalar()
    return train, fc.forecast(newest, train).withColumn("version", versions)


@query("a15_model_versions", recursive_sql("""
select area, consumer_type, t as datetime_utc, round(p, 4) as energy_consumption, true as same, 2 as version from steps where step > 0""",
                                           *FIT_OF_TRAIN, recursion("hi - interval 24 hour", **FITTED_STEP)))
def a15(spark, sf_dir):
    """Forecasts of a stored and reloaded model over all features, whose normal equations SQL solves; ``same`` compares them
    with those of the solved equations."""
    config = {"reg_lambda": 0.01}
    train, predicted = _registered(spark, sf_dir, config)
    solved = fc.forecast(fc.solve(train, config), train).withColumnRenamed("energy_consumption", "other")
    close = F.abs(F.col("energy_consumption") - F.col("other")) < 1e-6
    return predicted.join(solved, [*ROW_KEYS]).select(
        *ROW_KEYS, F.round("energy_consumption", 4).alias("energy_consumption"), F.coalesce(close, F.lit(False)).alias("same"), "version")


@query("a15b_versions_of_a_line", dense_sql(TEST_FORECAST.replace("from lagged", ", 2 as version from lagged"), LAGGED, LINE_OF_TRAIN))
def a15b(spark, sf_dir):
    return rounded(_registered(spark, sf_dir, LINE)[1], "energy_consumption")


@query("a16_hour_codec", panel_sql("""
select area, consumer_type, date_diff('hour', timestamp '1970-01-01', datetime_utc) as epoch_hours,
       datetime_utc as decoded from panel"""))
def a16(spark, sf_dir):
    coded = fixtures.panel(spark, sf_dir).select("area", "consumer_type", epoch_hour("datetime_utc").alias("epoch_hours"))
    return coded.withColumn("decoded", from_epoch_hour("epoch_hours"))
