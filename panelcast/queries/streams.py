"""N: Structured Streaming, drained and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast import fixtures
from panelcast.operators.timeseries import shift_hours
from panelcast.queries.registry import query, rounded
from panelcast.queries.sql import RAW, ctes, panel_sql
from panelcast.schemas import FORECAST, RAW as RAW_SCHEMA
from panelcast.session import scratch_path
from panelcast.sources.feature_store import Features, read_features
from panelcast.sources.feature_table import read_table
from panelcast.streaming import jobs

HOURLY = f"""hourly as (
  select date_trunc('hour', ts) as hour, date_trunc('hour', ts) + interval 1 hour as hour_end, event_type,
         cast(sum(cast(value as decimal(18,2))) as double) as total from events group by 1, 2, 3)"""


def drained(stream_query):
    stream_query.awaitTermination()
    if stream_query.exception():
        raise stream_query.exception()


@query("n01_incremental_ingest", panel_sql("select * from panel"))
def n01(spark, sf_dir):
    landing, table = scratch_path(spark, "landing"), scratch_path(spark, "stream-table")
    fixtures.raw(spark, sf_dir).repartition(3, F.substring("HourUTC", 1, 10)).write.parquet(landing)
    drained(jobs.start_ingest(
        spark, landing, table, scratch_path(spark, "stream-checkpoint"), files_per_batch=2
    ))
    return read_table(spark, table)


@query("n01b_stream_features", panel_sql("""
select p.*, a.energy_consumption as lag_1, b.energy_consumption as lag_24 from panel p
left join panel a on a.area = p.area and a.consumer_type = p.consumer_type and a.datetime_utc = p.datetime_utc - interval 1 hour
left join panel b on b.area = p.area and b.consumer_type = p.consumer_type and b.datetime_utc = p.datetime_utc - interval 24 hour"""))
def n01b(spark, sf_dir):
    """Landed files in any order of days, ingested batch by batch; each brings the stored lags of the days it reaches up to date."""
    landing, table = scratch_path(spark, "landing"), scratch_path(spark, "stream-table")
    features = Features(lags=(1, 24), means=(), stds=(), with_calendar=False, full=False)
    fixtures.raw(spark, sf_dir).repartition(3, F.substring("HourUTC", 1, 10)).write.parquet(landing)
    drained(jobs.start_ingest(
        spark, landing, table, scratch_path(spark, "stream-checkpoint"), files_per_batch=2, features=features
    ))
    return read_features(spark, table, features)


@query("n02_stream_dedupe", ctes(RAW) + 'select "HourUTC", "PriceArea", "ConsumerType_DE35", "TotalCon" from raw')
def n02(spark, sf_dir):
    landing, out = scratch_path(spark, "doubled"), scratch_path(spark, "deduplicated")
    raw = fixtures.raw(spark, sf_dir)
    raw.write.parquet(landing)
    raw.write.mode("append").parquet(landing)
    stream = jobs.landed_stream(spark, landing, RAW_SCHEMA).withColumn(
        "datetime_utc", F.to_timestamp_ntz("HourUTC", F.lit("yyyy-MM-dd HH:mm"))
    )
    unique = jobs.deduplicate(stream, ("PriceArea", "ConsumerType_DE35", "datetime_utc"))
    drained(jobs.start_append(unique.drop("datetime_utc"), out, scratch_path(spark, "dedupe-checkpoint")))
    return spark.read.schema(RAW_SCHEMA).parquet(out).drop("HourDK")


@query("n03_hourly_totals", ctes(HOURLY) + """
select * from hourly where hour_end <= (select max(ts) - interval 1 hour from events)""")
def n03(spark, sf_dir):
    out = scratch_path(spark, "hourly")
    schema = fixtures.events(spark, sf_dir).schema
    stream = jobs.landed_stream(spark, sf_dir, schema, "events.parquet")
    totals = jobs.hourly_totals(stream, ("event_type",))
    drained(jobs.start_append(totals, out, scratch_path(spark, "hourly-checkpoint")))
    return spark.read.schema(totals.schema).parquet(out)


@query("n04_late_truth_scores", panel_sql("""
select a.datetime_utc, round(avg(abs(a.energy_consumption - b.energy_consumption)
       / greatest(abs(a.energy_consumption), 2.220446049250313e-16)), 6) as "MAPE"
from panel a join panel b on a.area = b.area and a.consumer_type = b.consumer_type
     and b.datetime_utc = a.datetime_utc - interval 24 hour
group by 1"""))
def n04(spark, sf_dir):
    """Yesterday's value as the published forecast of each hour, scored as observations arrive."""
    panel = fixtures.panel(spark, sf_dir).select(*FORECAST.names)
    forecasts, truth = scratch_path(spark, "forecasts"), scratch_path(spark, "truth")
    shift_hours(panel, 24).write.parquet(forecasts)
    panel.write.parquet(truth)
    errors = jobs.matched_errors(
        jobs.landed_stream(spark, forecasts, FORECAST),
        jobs.landed_stream(spark, truth, FORECAST),
    )
    partials = scratch_path(spark, "score-parts")
    drained(jobs.start_scoring(errors, partials, scratch_path(spark, "score-checkpoint")))
    return rounded(jobs.read_scores(spark, partials), "MAPE")


@query("n04b_closed_scores", panel_sql("""
select a.datetime_utc, round(avg(abs(a.energy_consumption - b.energy_consumption)
       / greatest(abs(a.energy_consumption), 2.220446049250313e-16)), 6) as "MAPE", count(*) as n
from panel a join panel b on a.area = b.area and a.consumer_type = b.consumer_type
     and b.datetime_utc = a.datetime_utc - interval 24 hour
where a.datetime_utc + interval 1 hour <= (select hi - interval 36 hour from span)
group by 1"""))
def n04b(spark, sf_dir):
    """Yesterday's value as the forecast; hours are scored once, when the watermark (36 hours) has closed them."""
    panel = fixtures.panel(spark, sf_dir).select(*FORECAST.names)
    forecasts, truth, root = (scratch_path(spark, n) for n in ("forecasts", "truth", "closed-scores"))
    shift_hours(panel, 24).write.parquet(forecasts)
    panel.write.parquet(truth)
    scores = jobs.closed_scores(
        jobs.landed_stream(spark, forecasts, FORECAST), jobs.landed_stream(spark, truth, FORECAST), delay="36 hours")
    drained(jobs.start_closed_scores(scores, root, scratch_path(spark, "closed-checkpoint")))
    return rounded(jobs.read_closed_scores(spark, root), "MAPE")
