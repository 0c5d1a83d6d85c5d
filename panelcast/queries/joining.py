"""D: joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast import fixtures
from panelcast.operators import clean, joins
from panelcast.plans.training import split
from panelcast.operators.forecast import observed
from panelcast.operators.timeseries import seasonal_naive
from panelcast.queries.cleaning import merged
from panelcast.queries.registry import query
from panelcast.queries.sql import CACHED, MERGED, NEW, PAIRS, TRUTH, dense_sql, panel_sql


@query("d01_outer_merge", dense_sql("select * from merged", CACHED, NEW, MERGED))
def d01(spark, sf_dir):
    return merged(spark, sf_dir)


@query("d02_overlay_cached_wins", dense_sql("""
select area, consumer_type, datetime_utc,
       coalesce(energy_consumption_cached, energy_consumption_new) as energy_consumption from merged""",
                                            CACHED, NEW, MERGED))
def d02(spark, sf_dir):
    return joins.overlay(merged(spark, sf_dir))


@query("d03_truth_update", dense_sql("""
select f.area, f.consumer_type, f.datetime_utc, f.energy_consumption as energy_consumption_predictions,
       t.energy_consumption as energy_consumption_observations
from fresh f join truth t using (area, consumer_type, datetime_utc)""", NEW, TRUTH))
def d03(spark, sf_dir):
    forecasts = fixtures.new_forecasts(fixtures.dense(spark, sf_dir)).withColumnRenamed(
        "energy_consumption", "energy_consumption_predictions"
    )
    waiting = clean.with_empty(forecasts, "energy_consumption_observations")
    updated = joins.update_from(waiting, fixtures.late_truth(fixtures.panel(spark, sf_dir)))
    return clean.drop_missing(updated, ["energy_consumption_observations"])


@query("d03b_attach_truth", dense_sql("""
select f.area, f.consumer_type, f.datetime_utc, f.energy_consumption as energy_consumption_predictions,
       t.energy_consumption as energy_consumption_observations
from cached f join truth t using (area, consumer_type, datetime_utc)""", CACHED, TRUTH))
def d03b(spark, sf_dir):
    forecasts = fixtures.cached_forecasts(fixtures.dense(spark, sf_dir))
    return joins.attach_truth(forecasts, fixtures.late_truth(fixtures.panel(spark, sf_dir)))


@query("d04_horizon_grid", panel_sql("""
, kept as (select * from panel where not (area = 2 and consumer_type = 122))
select a.area, c.consumer_type, m.hi + to_hours(cast(s as integer)) as datetime_utc
from (select distinct area from kept) a, (select distinct consumer_type from kept) c,
     (select max(datetime_utc) as hi from kept) m, range(1, 25) t(s)"""))
def d04(spark, sf_dir):
    unseen = (F.col("area") == 2) & (F.col("consumer_type") == 122)
    return joins.horizon_grid(fixtures.panel(spark, sf_dir).filter(~unseen), 24)


@query("d05_misaligned_rows", dense_sql("""
select area, consumer_type, datetime_utc, case when f.energy_consumption is null then 'right' else 'left' end as only_in
from fresh f full outer join cached c using (area, consumer_type, datetime_utc)
where f.energy_consumption is null or c.energy_consumption is null""", CACHED, NEW))
def d05(spark, sf_dir):
    hourly = fixtures.dense(spark, sf_dir)
    return joins.misaligned(fixtures.new_forecasts(hourly), fixtures.cached_forecasts(hourly))


@query("d06_actual_forecast_pairs", dense_sql("select * from pairs", PAIRS))
def d06(spark, sf_dir):
    train, test = split(fixtures.dense(spark, sf_dir))
    return joins.pair(observed(test), seasonal_naive(train))


@query("d07_fill_hours", panel_sql("""
, bounds as (select area, consumer_type, min(datetime_utc) as lo, max(datetime_utc) as hi from panel group by 1, 2),
grid as (select area, consumer_type, unnest(generate_series(lo, hi, interval 1 hour)) as datetime_utc from bounds)
select g.area, g.consumer_type, g.datetime_utc, p.energy_consumption
from grid g left join panel p using (area, consumer_type, datetime_utc)"""))
def d07(spark, sf_dir):
    return joins.fill_hours(fixtures.panel(spark, sf_dir))


@query("d07b_dense_panel", dense_sql("select * from dense"))
def d07b(spark, sf_dir):
    return fixtures.dense(spark, sf_dir)
