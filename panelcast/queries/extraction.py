"""B: extraction windows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from panelcast import fixtures
from panelcast.functions.hours import parse_logical_date
from panelcast.operators import windows
from panelcast.plans.ingest import in_window
from panelcast.queries.registry import query
from panelcast.queries.sql import RAW, ctes, panel_sql

WINDOWS_SQL = """
, refs as (select hi - to_days(cast(d as integer)) as reference from span, range(10) t(d)),
ends as (select least(reference, hi + interval 1 day) - interval 1 day as e from refs, span),
windows as (
  select greatest(e - interval 3 day, lo) as window_start,
         case when e - interval 3 day < lo then lo + interval 3 day else e end as window_end from ends, span)"""


@query("b01_export_windows", """
with anchored as (
  select event_id, least(date_trunc('hour', ts), timestamp '2024-01-27 12:00:00') - interval 2 day as e from events)
select event_id, greatest(e - interval 3 day, timestamp '2024-01-03 00:00:00') as window_start,
       case when e - interval 3 day < timestamp '2024-01-03 00:00:00' then timestamp '2024-01-06 00:00:00'
            else e end as window_end
from anchored""")
def b01(spark, sf_dir):
    references = fixtures.events(spark, sf_dir).select("event_id", F.col("ts").alias("reference"))
    bounds = {"dataset_start": datetime(2024, 1, 3), "dataset_end": datetime(2024, 1, 25, 12)}
    return windows.export_windows(references, days_delay=2, days_export=3, **bounds).drop("reference")


@query("b02_half_open_range", ctes(RAW) + """
select * from raw where strptime("HourUTC", '%Y-%m-%d %H:%M') >= timestamp '2024-01-05 00:00:00'
  and strptime("HourUTC", '%Y-%m-%d %H:%M') < timestamp '2024-01-12 07:00:00'""")
def b02(spark, sf_dir):
    return in_window(fixtures.raw(spark, sf_dir), datetime(2024, 1, 5), datetime(2024, 1, 12, 7))


@query("b03_logical_dates", "select event_id, date_trunc('second', ts) as logical_date from events")
def b03(spark, sf_dir):
    micros = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("+00:00"))
    seconds = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit("+02:00"))
    text = F.when(F.col("event_id") % 2 == 0, micros).otherwise(seconds)
    return fixtures.events(spark, sf_dir).select("event_id", parse_logical_date(text).alias("logical_date"))


def backfill_windows(panel):
    span = panel.agg(F.min("datetime_utc").alias("lo"), F.max("datetime_utc").alias("hi"))
    return windows.export_windows(
        windows.daily_references(panel, 10), days_delay=1, days_export=3,
        dataset_start=span.select("lo").scalar(), dataset_end=span.select("hi").scalar(),
    ).select("window_start", "window_end")


@query("b04_backfill", panel_sql(WINDOWS_SQL + """
select w.window_start, w.window_end, p.* from panel p join windows w
  on p.datetime_utc >= w.window_start and p.datetime_utc < w.window_end"""))
def b04(spark, sf_dir):
    panel = fixtures.panel(spark, sf_dir)
    return windows.backfill(panel, backfill_windows(panel))


@query("b04b_backfill_coverage", panel_sql(WINDOWS_SQL + """
select w.window_start, w.window_end, count(*) as rows, count(distinct p.datetime_utc) as hours
from panel p join windows w on p.datetime_utc >= w.window_start and p.datetime_utc < w.window_end group by 1, 2"""))
def b04b(spark, sf_dir):
    panel = fixtures.panel(spark, sf_dir)
    return windows.backfill_coverage(panel, backfill_windows(panel))


@query("b05_completeness", panel_sql("""
select cast(720 as bigint) as expected, count(distinct datetime_utc) as actual,
       count(distinct datetime_utc) >= 720 as ok from panel"""))
def b05(spark, sf_dir):
    return windows.completeness(fixtures.panel(spark, sf_dir))


@query("b05b_completeness_by_series", panel_sql("""
select area, consumer_type, cast(720 as bigint) as expected, count(distinct datetime_utc) as actual,
       count(distinct datetime_utc) >= 720 as ok from panel group by 1, 2"""))
def b05b(spark, sf_dir):
    return windows.completeness_by_series(fixtures.panel(spark, sf_dir), ("area", "consumer_type"))


@query("b06_export_metadata", panel_sql("""
select 15 as days_delay, 30 as days_export, 'events' as url, '2024-01-01 00:00' as export_datetime_utc_start,
       '2024-01-31 00:00' as export_datetime_utc_end, 'yyyy-MM-dd HH:mm' as datetime_format,
       count(distinct datetime_utc) as num_unique_samples_per_time_series from panel"""))
def b06(spark, sf_dir):
    panel = fixtures.panel(spark, sf_dir)
    return windows.export_metadata(panel, datetime(2024, 1, 1), datetime(2024, 1, 31), "events")
