"""Time-series operators on a panel with many series and a hot one, under other column names."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast import fixtures
from panelcast.operators import forecast as fc
from panelcast.operators import timeseries as ts
from panelcast.operators.aggregates import score_slices
from panelcast.operators.joins import fill_hours
from panelcast.queries.registry import query, rounded
from panelcast.queries.sql import APE, ctes

NAMES = {"keys": ("user_id",), "time": "hour", "value": "total"}

USERS = """users as (
  select cast(case when user_id % 3 = 0 then 0 else user_id end as bigint) as user_id, date_trunc('hour', ts) as hour,
         cast(sum(cast(value as decimal(18,2))) as double) as total
  from events group by 1, 2)"""
HOURLY = """spans as (select user_id, min(hour) as lo, max(hour) as hi from users group by 1),
hourly as (
  select s.user_id, s.hour, coalesce(u.total, 0.0) as total, u.total is not null as observed
  from (select user_id, unnest(generate_series(lo, hi, interval 1 hour)) as hour from spans) s
  left join users u on u.user_id = s.user_id and u.hour = s.hour)"""
OVER = "over (partition by user_id order by hour"


def hourly(spark, sf_dir):
    return fill_hours(fixtures.user_panel(spark, sf_dir), fill=0.0, observed="observed", **NAMES)


@query("d07c_user_gaps", ctes(USERS, HOURLY) + "select * from hourly")
def d07c(spark, sf_dir):
    return hourly(spark, sf_dir)


@query("f01b_user_lags", ctes(USERS) + """
select u.*, a.total as lag_1, b.total as lag_24 from users u
left join users a on a.user_id = u.user_id and a.hour = u.hour - interval 1 hour
left join users b on b.user_id = u.user_id and b.hour = u.hour - interval 24 hour""")
def f01b(spark, sf_dir):
    return ts.lags(fixtures.user_panel(spark, sf_dir), (1, 24), **NAMES)


@query("f02b_user_windows", ctes(USERS, HOURLY) + f"""
select user_id, hour, total,
       case when count(*) {OVER} rows between 24 preceding and 1 preceding) = 24
            then round(avg(total) {OVER} rows between 24 preceding and 1 preceding), 6) end as mean_1_24,
       case when count(*) {OVER} rows between 24 preceding and 1 preceding) = 24
            then round(stddev_samp(total) {OVER} rows between 24 preceding and 1 preceding), 6) end as std_1_24
from hourly""")
def f02b(spark, sf_dir):
    table = hourly(spark, sf_dir).drop("observed")
    means = ts.rolling_mean(table, ((1, 24),), **NAMES)
    return rounded(ts.rolling_std(means, ((1, 24),), **NAMES), "mean_1_24", "std_1_24")


@query("f04b_user_history", ctes(USERS, HOURLY) + f"""
select user_id, hour, total, string_agg(cast(cast(total as decimal(18,2)) as varchar), ',') {OVER} rows between 24 preceding and 1 preceding) as history
from hourly qualify count(*) {OVER} rows between 24 preceding and 1 preceding) = 24""")
def f04b(spark, sf_dir):
    full = ts.full_history(ts.history(hourly(spark, sf_dir).drop("observed"), 24, **NAMES), 24)
    text = F.array_join(F.transform("history", lambda x: x.cast("decimal(18,2)").cast("string")), ",")
    return full.withColumn("history", text)


@query("f06b_user_split", ctes(USERS) + f"""
select *, case when row_number() {OVER} desc) <= 24 then 'test' else 'train' end as split from users""")
def f06b(spark, sf_dir):
    return ts.label_last_hours(fixtures.user_panel(spark, sf_dir), 24, NAMES["keys"], NAMES["time"])


@query("e07b_user_slices", ctes(USERS) + f"""
, pairs as (select u.user_id, u.total as y, a.total as p from users u join users a on a.user_id = u.user_id and a.hour = u.hour - interval 24 hour)
select user_id, round(sqrt(avg(pow({APE}, 2))), 6) as "RMSPE", round(avg({APE}), 6) as "MAPE", false as overall from pairs group by 1
union all select -1, round(sqrt(avg(pow({APE}, 2))), 6), round(avg({APE}), 6), true from pairs""")
def e07b(spark, sf_dir):
    pairs = ts.lags(fixtures.user_panel(spark, sf_dir), (24,), **NAMES).where("lag_24 is not null")
    scores = score_slices(pairs.select("user_id", F.col("total").alias("y"), F.col("lag_24").alias("p")), NAMES["keys"])
    return rounded(scores.withColumn("user_id", F.coalesce("user_id", F.lit(-1).cast("bigint"))), "RMSPE", "MAPE")


@query("k03c_user_forecast", ctes(USERS, HOURLY) + f"""
, line as (select regr_slope(total, l) as b, regr_intercept(total, l) as a from (select total, lag(total, 24) {OVER}) as l from hourly)),
latest as (select max(hour) as t from users)
select h.user_id, t + to_hours(cast(s as integer)) as hour, round(a + b * coalesce(u.total, 0.0), 6) as total
from (select distinct user_id from users, latest where hour > t - interval 24 hour) h, line, latest, range(1, 25) r(s)
left join users u on u.user_id = h.user_id and u.hour = t + to_hours(cast(s as integer)) - interval 24 hour""")
def k03c(spark, sf_dir):
    """All series advance 24 hours from the table's last hour by one line on the value a day earlier."""
    table = hourly(spark, sf_dir)
    line = fc.lag_regression(ts.lags(table, (24,), **NAMES), "lag_24", NAMES["value"])
    weights = line.select(
        F.concat(F.array("slope"), F.array_repeat(F.lit(0.0), 23)).alias("lag"), F.array().cast("array<double>").alias("std"),
        F.array(F.lit(0.0), F.lit(0.0)).alias("calendar"), F.array(F.lit(0.0)).alias("key"), "intercept",
    )
    state = fc.latest_history(fixtures.user_panel(spark, sf_dir), 24, **NAMES)
    done = fc.forecast_with(state, weights, (), 24, NAMES["keys"])
    return rounded(fc.as_rows(done, 24, **NAMES), "total")
