"""O: user functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast import fixtures
from panelcast.operators import hooks
from panelcast.operators.aggregates import pages
from panelcast.queries.aggregation import pairs
from panelcast.queries.registry import query, rounded
from panelcast.queries.sql import APE, PAIRS, dense_sql, panel_sql


@query("o01_user_metric", dense_sql(f'select datetime_utc, round(avg({APE}), 6) as "MAPE" from pairs group by 1', PAIRS))
def o01(spark, sf_dir):
    error = hooks.pointwise(lambda y, p: (y - p).abs() / y.abs().clip(lower=2.220446049250313e-16))
    scored = pairs(spark, sf_dir).groupBy("datetime_utc").agg(F.avg(error).alias("MAPE"))
    return rounded(scored, "MAPE")


GROWTH = 1.01 / 0.99


@query("o01b_group_lambda", dense_sql(f"""
select area, consumer_type, round(avg({APE}), 6) as "MAPE" from pairs group by 1, 2""", PAIRS))
def o01b(spark, sf_dir):
    """The mean error of each slice by a user's function over its rows, as states that are merged."""
    aggregate = hooks.GroupMean(lambda rows: (rows["y"] - rows["p"]).abs() / rows["y"].abs().clip(lower=2.220446049250313e-16), "MAPE")
    return rounded(hooks.aggregate_by(pairs(spark, sf_dir), ("area", "consumer_type"), aggregate, ("y", "p")), "MAPE")


@query("o01c_group_median", f"""
with counted as (
  select event_type, cast(sign(value) as integer) as s,
         case when value = 0 then 0 else cast(ceil(ln(abs(value)) / ln({GROWTH!r})) as integer) end as step, count(*) as n
  from events where value is not null group by 1, 2, 3),
placed as (
  select *, sum(n) over (partition by event_type order by s, s * step) as seen, sum(n) over (partition by event_type) as total from counted),
reached as (
  select *, row_number() over (partition by event_type order by s, s * step) as r from placed where seen > 0.5 * (total - 1))
select event_type, round(case when s = 0 then 0.0 else s * 2 * pow({GROWTH!r}, step) / ({GROWTH!r} + 1) end, 6) as median from reached where r = 1""")
def o01c(spark, sf_dir):
    """The median of all events of a type, to one percent, by a sketch of a user."""
    median = hooks.GroupQuantile("value", 0.5, 0.01, "median")
    events = fixtures.events(spark, sf_dir).select("event_type", F.col("value").cast("double").alias("value"))
    return rounded(hooks.aggregate_by(events, ("event_type",), median, ("value",)), "median")


@query("o02_arrays_to_rows", panel_sql("""
select area, consumer_type, date_diff('hour', timestamp '1970-01-01', datetime_utc) as datetime_utc, energy_consumption
from panel"""))
def o02(spark, sf_dir):
    paged = pages(fixtures.panel(spark, sf_dir))
    return hooks.rows_of(paged, "datetime_utc", "energy_consumption", keep=("area", "consumer_type"))


@query("o03_user_forecaster", dense_sql("""
select d.area, d.consumer_type, hi + to_hours(cast(s as integer)) as datetime_utc,
       round(avg(d.energy_consumption), 6) as energy_consumption
from dense d, span, range(1, 25) t(s) where d.datetime_utc > hi - interval 168 hour group by 1, 2, 3"""))
def o03(spark, sf_dir):
    """Weekly mean as the forecast of each of the next 24 hours."""
    def weekly_mean(rows):
        import pandas as pd
        last = rows["datetime_utc"].iloc[-1]
        return pd.DataFrame({
            "area": rows["area"].iloc[0], "consumer_type": rows["consumer_type"].iloc[0],
            "datetime_utc": pd.date_range(last, periods=25, freq="h")[1:],
            "energy_consumption": rows["energy_consumption"].mean(),
        })

    return rounded(hooks.forecast_each(fixtures.dense(spark, sf_dir), weekly_mean, 168), "energy_consumption")
