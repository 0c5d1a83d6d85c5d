"""M: cache merge, monitoring and result pages."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from panelcast import fixtures
from panelcast.functions.hours import add_hours
from panelcast.operators import forecast as fc
from panelcast.operators.aggregates import score
from panelcast.operators.joins import key_product
from panelcast.operators.timeseries import newest
from panelcast.plans import monitoring, pages, prediction, training
from panelcast.queries.aggregation import HOUR, money_list, text_list
from panelcast.queries.registry import listed, lists_as_text, query, rounded
from panelcast.queries.sql import (
    CACHED, FIT_OF_TRAIN, FITTED_STEP, LAGGED, LINE, LINE_OF_TRAIN, MERGED, NEW, TRUTH, dense_sql, panel_sql, recursion, recursive_sql,
)
from panelcast.schemas import FORECAST, ROW_KEYS
from panelcast.session import scratch_path
from panelcast.sources.feature_table import read_range, upsert
from panelcast.sources.models import register_model
from panelcast.sources.results import publish

PAGE_SQL = "cast(floor(date_diff('hour', timestamp '1970-01-01', datetime_utc) / 8784) as integer)"
CACHE = """cache as (
  select area, consumer_type, datetime_utc,
         coalesce(energy_consumption_cached, energy_consumption_new) as energy_consumption
  from merged, span where datetime_utc >= hi - interval 30 hour)"""
# Observations of the last 36 hours, restricted to the span of the cache.
SCORED = """scored as (
  select t.area, t.consumer_type, t.datetime_utc, t.energy_consumption as y, c.energy_consumption as p
  from truth t join cache c using (area, consumer_type, datetime_utc))"""
CACHE_PARTS = (CACHED, NEW, MERGED, CACHE)


def cache(spark, sf_dir):
    hourly = fixtures.dense(spark, sf_dir)
    start = add_hours(fixtures.latest(hourly), -30)
    return prediction.merge_into_cache(fixtures.new_forecasts(hourly), fixtures.cached_forecasts(hourly), start)


def truth(spark, sf_dir):
    return fixtures.late_truth(fixtures.panel(spark, sf_dir))


@query("m01_forecast_cache", dense_sql("select * from cache", *CACHE_PARTS))
def m01(spark, sf_dir):
    """Through the stored cache: published, merged by day in one commit, read back."""
    root = scratch_path(spark, "forecast-cache")
    hourly = fixtures.dense(spark, sf_dir)
    publish({"predictions_monitoring": fixtures.cached_forecasts(hourly)}, root)
    start = add_hours(fixtures.latest(hourly), -30)
    return prediction.update_cache(spark, fixtures.new_forecasts(hourly), root, start)


FIRST, END = datetime(2024, 1, 1), datetime(2024, 1, 30, 12)


def predicted(spark, sf_dir, config):
    root, table = scratch_path(spark, "batch"), scratch_path(spark, "batch-table")
    upsert(spark, table, fixtures.panel(spark, sf_dir))
    train, test = training.split(fixtures.dense(spark, sf_dir))
    model = fc.fit(train, config)
    register_model(spark, model, score(fc.evaluate(model, train, test)), f"{root}/models", "best_model", {"fill": "zero"})
    return train, table, prediction.run_prediction(spark, table, f"{root}/models", root, FIRST, END)


RANGED = """ranged as (select * from panel where datetime_utc >= timestamp '2024-01-01' and datetime_utc < timestamp '2024-01-30 12:00:00'),
latest as (select max(datetime_utc) as last from ranged)"""
PRODUCT = "select * from (select distinct area from ranged), (select distinct consumer_type from ranged)"


@query("m02_batch_prediction", recursive_sql("""
, given as (
  select area, consumer_type, t as datetime_utc, p, exists (select 1 from ranged r, latest where r.area = s.area and r.consumer_type = s.consumer_type
         and r.datetime_utc > last - interval 72 hour) as forecast
  from steps s where step > 0)
select area, consumer_type, datetime_utc, case when forecast then round(p, 4) end as energy_consumption, forecast, true as same from given""",
                                             *FIT_OF_TRAIN, RANGED, recursion("last", **FITTED_STEP, keys=PRODUCT, table="ranged", cuts="latest")))
def m02(spark, sf_dir):
    """Forecasts of a stored model over all features, run from stored tables; SQL solves its normal equations, and ``same``
    compares them with those of the solved equations."""
    config = {"reg_lambda": 0.01}
    train, table, published = predicted(spark, sf_dir, config)
    panel = read_range(spark, table, FIRST, END)
    other = fc.forecast(fc.solve(train, config), panel, series=key_product(panel)).withColumnRenamed("energy_consumption", "other")
    both = F.col("energy_consumption").isNull() & F.col("other").isNull()
    same = F.coalesce(both | (F.abs(F.col("energy_consumption") - F.col("other")) < 1e-6), F.lit(False))
    return published.join(other, list(ROW_KEYS)).select(
        *ROW_KEYS, F.round("energy_consumption", 4).alias("energy_consumption"), F.col("energy_consumption").isNotNull().alias("forecast"), same.alias("same"))


@query("m02b_batch_prediction_of_a_line", dense_sql("""
, ranged as (select * from panel where datetime_utc >= timestamp '2024-01-01' and datetime_utc < timestamp '2024-01-30 12:00:00'),
latest as (select max(datetime_utc) as t from ranged),
recent as (select r.* from ranged r, latest where datetime_utc > t - interval 24 hour)
select k.area, c.consumer_type, t + to_hours(cast(s as integer)) as datetime_utc,
       case when exists (select 1 from recent r where r.area = k.area and r.consumer_type = c.consumer_type)
            then round(a + b * coalesce(v.energy_consumption, 0.0), 6) end as energy_consumption
from (select distinct area from ranged) k, (select distinct consumer_type from ranged) c, latest, line, range(1, 25) h(s)
left join recent v on v.area = k.area and v.consumer_type = c.consumer_type
     and v.datetime_utc = t + to_hours(cast(s as integer)) - interval 24 hour""", LAGGED, LINE_OF_TRAIN))
def m02b(spark, sf_dir):
    return rounded(predicted(spark, sf_dir, LINE)[2], "energy_consumption")


@query("m03_monitoring_metrics", dense_sql("""
select datetime_utc, round(avg(abs(y - p) / greatest(abs(y), 2.220446049250313e-16)), 6) as "MAPE"
from scored group by 1""", *CACHE_PARTS, TRUTH, SCORED))
def m03(spark, sf_dir):
    observed = fc.observed(truth(spark, sf_dir))
    return rounded(monitoring.hourly_scores(cache(spark, sf_dir), observed), "MAPE")


@query("m03b_monitoring_run", dense_sql("""
select t.area, t.consumer_type, t.datetime_utc, t.energy_consumption
from panel t, (select min(datetime_utc) as first, max(datetime_utc) as last from cache) c
where t.datetime_utc between c.first and c.last""", *CACHE_PARTS))
def m03b(spark, sf_dir):
    """The whole run on stored tables; returns the published truth of the forecast span."""
    root, table = scratch_path(spark, "monitoring"), scratch_path(spark, "monitoring-table")
    upsert(spark, table, fixtures.panel(spark, sf_dir))
    publish({"predictions_monitoring": cache(spark, sf_dir)}, root)
    outcome = monitoring.run_monitoring(spark, table, root)
    if outcome != "published":
        raise RuntimeError(outcome)
    return monitoring.published_truth(spark, root)


@query("m04_consumer_type_values", panel_sql("select consumer_type as value, count(*) as rows from panel group by 1"))
def m04(spark, sf_dir):
    return pages.key_values(fixtures.panel(spark, sf_dir), "consumer_type")


@query("m05_area_values", panel_sql("select cast(area as integer) as value, count(*) as rows from panel group by 1"))
def m05(spark, sf_dir):
    return pages.key_values(fixtures.panel(spark, sf_dir), "area")


@query("m06_series_pages", dense_sql(f"""
, newest as (select *, row_number() over (partition by area, consumer_type order by datetime_utc desc) as r from panel),
obs as (select area, consumer_type, {text_list(HOUR)} as datetime_utc,
               {money_list('energy_consumption')} as energy_consumption from newest where r <= 168 group by 1, 2),
preds as (select area, consumer_type, {text_list(HOUR)} as preds_datetime_utc,
                 {money_list('energy_consumption')} as preds_energy_consumption from fresh group by 1, 2)
select * from obs join preds using (area, consumer_type)""", NEW))
def m06(spark, sf_dir):
    hourly = fixtures.dense(spark, sf_dir)
    page = pages.series_pages(fixtures.panel(spark, sf_dir), fixtures.new_forecasts(hourly))
    return lists_as_text(
        page, ("datetime_utc", "preds_datetime_utc"), ("energy_consumption", "preds_energy_consumption")
    )


@query("m07_metrics_page", dense_sql(f"""
, metrics as (select datetime_utc, avg(abs(y - p) / greatest(abs(y), 2.220446049250313e-16)) as m from scored group by 1)
select {PAGE_SQL} as page, {text_list(HOUR)} as datetime_utc,
       {text_list('cast(round(m, 4) as decimal(18,4))')} as mape from metrics group by 1""", *CACHE_PARTS, TRUTH, SCORED))
def m07(spark, sf_dir):
    page = pages.metrics_page(m03_exact(spark, sf_dir))
    four = F.transform("mape", lambda x: F.round(x, 4))
    return page.select("page", listed(F.col("datetime_utc")).alias("datetime_utc"),
                       listed(four, "decimal(18,4)").alias("mape"))


def m03_exact(spark, sf_dir):
    return monitoring.hourly_scores(cache(spark, sf_dir), fc.observed(truth(spark, sf_dir)))


@query("m08_truth_and_forecasts", dense_sql(f"""
, t as (select area, consumer_type, {PAGE_SQL} as page, {text_list(HOUR)} as y_monitoring_datetime_utc,
               {money_list('energy_consumption')} as y_monitoring_energy_consumption from truth group by 1, 2, 3),
c as (select area, consumer_type, {PAGE_SQL} as page, {text_list(HOUR)} as predictions_monitoring_datetime_utc,
             {money_list('energy_consumption')} as predictions_monitoring_energy_consumption from cache group by 1, 2, 3)
select area, consumer_type, page, coalesce(t.y_monitoring_datetime_utc, '') as y_monitoring_datetime_utc,
       coalesce(y_monitoring_energy_consumption, '') as y_monitoring_energy_consumption,
       coalesce(predictions_monitoring_datetime_utc, '') as predictions_monitoring_datetime_utc,
       coalesce(predictions_monitoring_energy_consumption, '') as predictions_monitoring_energy_consumption
from t full join c using (area, consumer_type, page)
where (area, consumer_type) in (select (area, consumer_type) from t) and (area, consumer_type) in (select (area, consumer_type) from c)""", *CACHE_PARTS, TRUTH))
def m08(spark, sf_dir):
    page = pages.comparison_pages(truth(spark, sf_dir), cache(spark, sf_dir))
    sides = ("y_monitoring", "predictions_monitoring")
    return lists_as_text(
        page, [f"{s}_datetime_utc" for s in sides], [f"{s}_energy_consumption" for s in sides]
    )


@query("m09_continuous_frame", panel_sql("""
, newest as (select * from (
    select *, row_number() over (partition by area, consumer_type order by datetime_utc desc) as r from panel)
  where r <= 168),
bounds as (select area, consumer_type, min(datetime_utc) as lo, max(datetime_utc) as hi from newest group by 1, 2),
grid as (select area, consumer_type, unnest(generate_series(lo, hi, interval 1 hour)) as datetime_utc from bounds)
select g.area, g.consumer_type, g.datetime_utc, p.energy_consumption
from grid g left join newest p using (area, consumer_type, datetime_utc)"""))
def m09(spark, sf_dir):
    observed = fixtures.panel(spark, sf_dir)
    ahead = newest(observed, 1).select(*FORECAST.names)
    return pages.continuous_frame(pages.series_pages(observed, ahead))
