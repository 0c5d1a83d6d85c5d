"""C: projections, filters and predicates."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from panelcast import fixtures
from panelcast.operators import clean, joins, windows
from panelcast.queries.registry import query
from panelcast.queries.sql import CACHED, CASE_TYPE, MERGED, NEW, RAW, TRUTH, ctes, dense_sql, panel_sql

RENAMED_SQL = """
select "HourUTC" as datetime_utc, "PriceArea" as area, "ConsumerType_DE35" as consumer_type,
       "TotalCon" as energy_consumption from raw"""


@query("c01_drop_columns", ctes(RAW) + 'select "HourUTC", "PriceArea", "ConsumerType_DE35", "TotalCon" from raw')
def c01(spark, sf_dir):
    return clean.drop_unused(fixtures.raw(spark, sf_dir))


@query("c02_rename_columns", ctes(RAW) + RENAMED_SQL)
def c02(spark, sf_dir):
    return fixtures.raw(spark, sf_dir).transform(clean.drop_unused).transform(clean.rename)


@query("c03_cast_types", ctes(RAW) + """
select strptime("HourUTC", '%Y-%m-%d %H:%M') as datetime_utc, "PriceArea" as area,
       cast("ConsumerType_DE35" as integer) as consumer_type, "TotalCon" as energy_consumption from raw""")
def c03(spark, sf_dir):
    return c02(spark, sf_dir).transform(clean.cast_types)


@query("c03b_rejected_rows", ctes(RAW) + """
select "PriceArea" || '-' || "HourUTC" as datetime_utc, "PriceArea" as area, "ConsumerType_DE35" as consumer_type,
       "TotalCon" as energy_consumption from raw where "TotalCon" < 5""")
def c03b(spark, sf_dir):
    spoiled = c02(spark, sf_dir).withColumn(
        "datetime_utc",
        F.when(F.col("energy_consumption") < 5, F.concat_ws("-", "area", "datetime_utc")).otherwise(F.col("datetime_utc")),
    )
    return clean.try_cast_types(spoiled)[1]


@query("c04_encode_area", panel_sql("select * from panel"))
def c04(spark, sf_dir):
    return c03(spark, sf_dir).transform(clean.encode_area)


@query("c05_clean", panel_sql("select * from panel"))
def c05(spark, sf_dir):
    return fixtures.raw(spark, sf_dir).transform(clean.clean)


def merged(spark, sf_dir):
    hourly = fixtures.dense(spark, sf_dir)
    return joins.merge_versions(fixtures.new_forecasts(hourly), fixtures.cached_forecasts(hourly))


@query("c06_strip_suffix", dense_sql("""
select area, consumer_type, datetime_utc, energy_consumption_new as energy_consumption from merged""",
                                     CACHED, NEW, MERGED))
def c06(spark, sf_dir):
    return clean.strip_suffix(merged(spark, sf_dir), "_new", ("area", "consumer_type", "datetime_utc"))


@query("c07_key_rows", f"""
select cast(user_id % 3 as tinyint) as area, {CASE_TYPE} as consumer_type, date_trunc('hour', ts) as datetime_utc,
       event_id, value from events""")
def c07(spark, sf_dir):
    rows = fixtures.events(spark, sf_dir).select(
        F.col("ts").alias("datetime_utc"), F.pmod("user_id", F.lit(3)).cast("tinyint").alias("area"),
        fixtures._type_code().alias("consumer_type"), "event_id", "value",
    )
    return clean.key_rows(rows)


@query("c08_target", panel_sql("select area, consumer_type, datetime_utc, energy_consumption from panel"))
def c08(spark, sf_dir):
    return clean.split_target(fixtures.panel(spark, sf_dir))[1]


@query("c08b_exogenous", panel_sql("select datetime_utc, area, consumer_type from panel"))
def c08b(spark, sf_dir):
    return clean.split_target(fixtures.panel(spark, sf_dir))[0]


@query("c09_attach_keys", panel_sql("select *, area as area_exog, consumer_type as consumer_type_exog from panel"))
def c09(spark, sf_dir):
    return clean.AttachKeys().transform(fixtures.panel(spark, sf_dir))


@query("c09b_detach_keys", panel_sql("select * from panel"))
def c09b(spark, sf_dir):
    stage = clean.AttachKeys()
    return stage.inverse(stage.transform(fixtures.panel(spark, sf_dir)))


@query("c10_drop_missing", dense_sql("""
select area, consumer_type, datetime_utc, energy_consumption_cached as energy_consumption
from merged where energy_consumption_cached is not null""", CACHED, NEW, MERGED))
def c10(spark, sf_dir):
    cached = clean.strip_suffix(merged(spark, sf_dir), "_cached", ("area", "consumer_type", "datetime_utc"))
    return clean.drop_missing(cached)


@query("c11_time_floor", panel_sql("select * from panel where datetime_utc >= timestamp '2024-01-20 12:00:00'"))
def c11(spark, sf_dir):
    return windows.since(fixtures.panel(spark, sf_dir), datetime(2024, 1, 20, 12))


@query("c12_one_series", panel_sql("select * from panel where area = 1 and consumer_type = 111"))
def c12(spark, sf_dir):
    return clean.one_series(fixtures.panel(spark, sf_dir), 1, 111)


@query("c13_found_series", panel_sql("""
, seen as (select distinct area, consumer_type from panel where energy_consumption > 60)
select a.area, c.consumer_type,
       exists (select 1 from seen s where s.area = a.area and s.consumer_type = c.consumer_type) as found
from (select distinct area from panel) a, (select distinct consumer_type from panel) c"""))
def c13(spark, sf_dir):
    panel = fixtures.panel(spark, sf_dir)
    return clean.found(joins.key_product(panel), panel.filter(F.col("energy_consumption") > 60))


@query("c14_empty_column", panel_sql("""
select *, cast(null as double) as energy_consumption_observations from panel"""))
def c14(spark, sf_dir):
    return clean.with_empty(fixtures.panel(spark, sf_dir), "energy_consumption_observations")
