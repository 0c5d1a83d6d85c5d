"""I: scalar functions, evaluated on every event."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast import fixtures
from panelcast.functions import hours
from panelcast.functions.errors import absolute_percentage_error
from panelcast.functions.payloads import as_json
from panelcast.queries.registry import query
from panelcast.queries.sql import panel_sql
from panelcast.schemas import PAYLOAD_TIME_FORMAT, RAW_TIME_FORMAT, REQUEST_TIME_FORMAT


@query("i01_format_time", """
select event_id, strftime(ts, '%Y-%m-%d %H:%M') as record, strftime(ts, '%Y-%m-%dT%H:%M') as request,
       strftime(ts, '%Y-%m-%dT%H:%M:%SZ') as payload from events""")
def i01(spark, sf_dir):
    return fixtures.events(spark, sf_dir).select(
        "event_id", hours.format_time("ts", RAW_TIME_FORMAT).alias("record"),
        hours.format_time("ts", REQUEST_TIME_FORMAT).alias("request"),
        hours.format_time("ts", PAYLOAD_TIME_FORMAT).alias("payload"),
    )


@query("i02_parse_time", """
select event_id, date_trunc('minute', ts) as record, date_trunc('second', ts) as payload from events""")
def i02(spark, sf_dir):
    return i01(spark, sf_dir).select(
        "event_id", hours.parse_time("record").alias("record"),
        hours.parse_time("payload", PAYLOAD_TIME_FORMAT).alias("payload"),
    )


@query("i03_truncate_time", """
select event_id, date_trunc('hour', ts) as to_hour, date_trunc('second', ts) as to_second from events""")
def i03(spark, sf_dir):
    return fixtures.events(spark, sf_dir).select(
        "event_id", hours.to_hour("ts").alias("to_hour"), hours.to_second("ts").alias("to_second")
    )


@query("i04_shift_time", """
select event_id, ts - interval 45 day as earlier, ts + interval 24 hour as later,
       ts + to_hours(cast(event_id % 72 as integer)) as shifted from events""")
def i04(spark, sf_dir):
    return fixtures.events(spark, sf_dir).select(
        "event_id", hours.add_days("ts", -45).alias("earlier"), hours.add_hours("ts", 24).alias("later"),
        hours.add_hours("ts", F.col("event_id") % 72).alias("shifted"),
    )


@query("i05_clamp_time", """
select event_id, greatest(least(ts, timestamp '2024-01-25 00:00:00'), timestamp '2024-01-05 12:00:00') as clamped
from events""")
def i05(spark, sf_dir):
    lower, upper = hours.ntz("2024-01-05 12:00:00"), hours.ntz("2024-01-25 00:00:00")
    return fixtures.events(spark, sf_dir).select("event_id", hours.clamp("ts", lower, upper).alias("clamped"))


@query("i06_iso_text", """
select event_id, date_diff('hour', timestamp '1970-01-01', date_trunc('hour', ts)) as period,
       strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M:%S') as iso from events""")
def i06(spark, sf_dir):
    period = hours.epoch_hour(hours.to_hour("ts"))
    return fixtures.events(spark, sf_dir).select(
        "event_id", period.alias("period"), hours.iso_text(hours.from_epoch_hour(period)).alias("iso")
    )


@query("i07_percentage_error", """
select event_id, round(abs(value - 10.0) / greatest(abs(value), 2.220446049250313e-16), 6) as ape
from events""")
def i07(spark, sf_dir):
    error = absolute_percentage_error(F.col("value"), F.lit(10.0))
    return fixtures.events(spark, sf_dir).select("event_id", F.round(error, 6).alias("ape"))


@query("i08_json_fields", panel_sql("select area, consumer_type, energy_consumption from panel"))
def i08(spark, sf_dir):
    encoded = fixtures.panel(spark, sf_dir).select(
        as_json("area", "consumer_type", "energy_consumption").alias("body")
    )
    schema = "area tinyint, consumer_type int, energy_consumption double"
    return encoded.select(F.from_json("body", schema).alias("b")).select("b.*")
