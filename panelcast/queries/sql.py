"""Common table expressions of the SQL side."""

from __future__ import annotations

CASE_TYPE = (
    "cast(case event_type when 'click' then 111 when 'error' then 112 when 'purchase' then 119 "
    "when 'signup' then 121 when 'view' then 122 end as integer)"
)
CASE_AREA = "case user_id % 3 when 0 then 'DK' when 1 then 'DK1' else 'DK2' end"

RAW = f"""raw as (
  select strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') as "HourUTC",
         strftime(date_trunc('hour', ts) + interval 1 hour, '%Y-%m-%d %H:%M') as "HourDK",
         {CASE_AREA} as "PriceArea", {CASE_TYPE} as "ConsumerType_DE35",
         cast(sum(cast(value as decimal(18,2))) as double) as "TotalCon"
  from events group by 1, 2, 3, 4)"""

PANEL = f"""panel as (
  select date_trunc('hour', ts) as datetime_utc, cast(user_id % 3 as tinyint) as area,
         {CASE_TYPE} as consumer_type,
         cast(sum(cast(value as decimal(18,2))) as double) as energy_consumption
  from events group by 1, 2, 3)"""

SPAN = "span as (select min(datetime_utc) as lo, max(datetime_utc) as hi from panel)"

DENSE = """hours as (
  select unnest(generate_series(lo, hi, interval 1 hour)) as datetime_utc from span),
dense as (
  select k.area, k.consumer_type, h.datetime_utc, coalesce(p.energy_consumption, 0.0) as energy_consumption,
         p.energy_consumption is not null as observed
  from (select distinct area, consumer_type from panel) k cross join hours h
  left join panel p on p.area = k.area and p.consumer_type = k.consumer_type and p.datetime_utc = h.datetime_utc)"""


def _forecast(name: str, back: int) -> str:
    return f"""{name} as (
  select d.area, d.consumer_type, d.datetime_utc + to_hours(24 * j) as datetime_utc, d.energy_consumption
  from dense d, span, (select unnest([1, 2]) as j) r
  where d.datetime_utc > hi - interval {back + 24} hour and d.datetime_utc <= hi - interval {back} hour)"""


CACHED = _forecast("cached", 48)
NEW = _forecast("fresh", 24)
TRUTH = """truth as (
  select area, consumer_type, datetime_utc, energy_consumption
  from panel, span where datetime_utc > hi - interval 36 hour)"""
MERGED = """merged as (
  select area, consumer_type, datetime_utc, f.energy_consumption as energy_consumption_new,
         c.energy_consumption as energy_consumption_cached
  from fresh f full outer join cached c using (area, consumer_type, datetime_utc))"""

# Last 24 hours scored against the value 24 hours earlier, on hours with an observation.
PAIRS = """pairs as (
  select t.area, t.consumer_type, t.datetime_utc, t.energy_consumption as y, e.energy_consumption as p
  from dense t join dense e on e.area = t.area and e.consumer_type = t.consumer_type
       and e.datetime_utc = t.datetime_utc - interval 24 hour, span
  where t.datetime_utc > hi - interval 24 hour and t.observed)"""

APE = "abs(y - p) / greatest(abs(y), 2.220446049250313e-16)"
BASE = (PANEL, SPAN, DENSE)

# One lag, no penalty, no other features: ordinary least squares, which SQL can state.
LINE = {"lag": (24,), "mean": (), "std": (), "calendar": False, "keys": False, "smallest_ridge": 0.0}

LAGGED = "lagged as (select *, lag(energy_consumption, 24) over (partition by area, consumer_type order by datetime_utc) as l from dense)"
LINE_OF_TRAIN = """line as (
  select regr_slope(energy_consumption, l) as b, regr_intercept(energy_consumption, l) as a
  from lagged, span where datetime_utc <= hi - interval 24 hour)"""
LINE_OF_ALL = "line as (select regr_slope(energy_consumption, l) as b, regr_intercept(energy_consumption, l) as a from lagged)"
LINE_PAIRS = """line_pairs as (
  select area, consumer_type, datetime_utc, energy_consumption as y, a + b * l as p
  from lagged, line, span where datetime_utc > hi - interval 24 hour and observed)"""
TEST_FORECAST = """
select area, consumer_type, datetime_utc, round(a + b * l, 6) as energy_consumption
from lagged, line, span where datetime_utc > hi - interval 24 hour"""
NEXT_FORECAST = """
select area, consumer_type, datetime_utc + interval 24 hour as datetime_utc, round(a + b * energy_consumption, 6) as energy_consumption
from dense, line, span where datetime_utc > hi - interval 24 hour"""


# All 82 features with weights by rule: SQL follows the same recursion, hour by hour.
LAG_WEIGHTS = tuple(0.01 * ((k * 7) % 5) / 5 for k in range(1, 73))
MEAN_WEIGHTS, STD_WEIGHTS = (0.2, 0.1, 0.05), (0.03, 0.02, 0.01)
OTHER_WEIGHTS, CONSTANT = (0.5, 0.25, 1.5, 0.125), 3.0
FIXED_COEFFICIENTS = (*LAG_WEIGHTS, *MEAN_WEIGHTS, *STD_WEIGHTS, *OTHER_WEIGHTS)


def recursion(cut: str, horizon: int = 24, value: str | None = None, beside: str = "", keys: str = "select distinct area, consumer_type from dense",
              table: str = "dense", cuts: str = "span") -> str:
    """``steps``: the forecasts of the hours after ``cut``, by the fixed weights over all 82 features or another expression
    over ``h``, the last 72 values, ``t``, the hour before, and the columns of tables ``beside``."""
    means = " + ".join(f"{w!r} * list_avg(h[{73 - n}:])" for w, n in zip(MEAN_WEIGHTS, (24, 48, 72)))
    stds = " + ".join(f"{w!r} * list_stddev_samp(h[{73 - n}:])" for w, n in zip(STD_WEIGHTS, (24, 48, 72)))
    day, hour, area, kind = OTHER_WEIGHTS
    linear = f"""{CONSTANT!r} + list_sum(list_transform(range(1, 73), lambda k: 0.01 * ((k * 7) % 5) / 5 * h[73 - k])) + {means} + {stds}
           + {day!r} * (isodow(t + interval 1 hour) - 1) + {hour!r} * hour(t + interval 1 hour) + {area!r} * area + {kind!r} * consumer_type"""
    return f"""steps(area, consumer_type, t, step, h, p) as (
  select k.area, k.consumer_type, c.t, 0, (
      select list(coalesce(d.energy_consumption, 0.0) order by x.i) from range(72) x(i)
      left join {table} d on d.area = k.area and d.consumer_type = k.consumer_type and d.datetime_utc = c.t - to_hours(cast(71 - x.i as integer))),
    cast(null as double)
  from ({keys}) k, (select {cut} as t from {cuts}) c
  union all
  select area, consumer_type, t + interval 1 hour, step + 1, list_append(h[2:], v), v from (
    select *, {value or linear} as v
    from steps{beside} where step < {horizon}))"""


def features_sql(hour: str) -> str:
    """All 82 features in their order, from ``h``, the 72 values before ``hour``."""
    return f"""list_concat(list_reverse(h), [list_avg(h[49:]), list_avg(h[25:]), list_avg(h), list_stddev_samp(h[49:]), list_stddev_samp(h[25:]),
    list_stddev_samp(h), isodow({hour}) - 1, hour({hour}), area, consumer_type])"""


# Every hour with a full history and its features, as the pooled fit has them.
FEATURED = f"""histories as (
  select *, list(energy_consumption) over (partition by area, consumer_type order by datetime_utc rows between 72 preceding and 1 preceding) as h
  from dense),
featured as (select area, consumer_type, datetime_utc, {features_sql('datetime_utc')} as x, energy_consumption as y from histories where len(h) = 72)"""

# ``solved``: coefficients ``c`` and intercept ``a`` of every trial (g, penalty) on the rows of ``design`` (g, r, x, y): least squares
# with a penalty in units of deviations, by elimination in the normal equations of the standardised features.
RIDGE = """cells as materialized (select g, r, unnest(range(1, len(x) + 2)) as f, unnest(list_append(x, y)) as v from design),
spreads as materialized (select g, f, avg(v) as mean, stddev_pop(v) as spread, max(f) over (partition by g) as target from cells group by g, f),
units as materialized (select g, r, f, case when spread > 0 then (v - mean) / spread else 0.0 end as z from cells join spreads using (g, f)),
gram as materialized (select a.g, a.f as i, b.f as j, avg(a.z * b.z) as v from units a join units b using (g, r) group by a.g, a.f, b.f),
elimination(trial, i, k, line) as (
  select trial, i, 0, list(v + case when i = j then penalty / s.spread else 0.0 end order by j)
  from trials join gram using (g) join spreads s on s.g = trials.g and s.f = s.target where i < s.target group by trial, i
  union all
  select e.trial, e.i, e.k + 1, case when e.i = e.k + 1 then e.line
         else list_transform(range(1, len(e.line) + 1), lambda j: e.line[j] - e.line[e.k + 1] / p.line[e.k + 1] * p.line[j]) end
  from elimination e join elimination p on p.trial = e.trial and p.i = e.k + 1),
weights as materialized (
  select trial, i, s.mean, case when s.spread > 0 then line[t.f] / line[i] * t.spread / s.spread else 0.0 end as w, t.mean as level
  from elimination join trials using (trial) join spreads s on s.g = trials.g and s.f = i join spreads t on t.g = s.g and t.f = t.target
  where k = t.f - 1),
solved as materialized (select trial, list(w order by i) as c, any_value(level) - sum(w * mean) as a from weights group by trial)"""

# One trial: the pooled fit with a penalty of 0.01 on the hours before the test, or on all.
ONE_TRIAL = "trials as (select 0 as trial, 0 as g, 0.01 as penalty)"
FIT_OF_ALL = (FEATURED, "design as (select 0 as g, row_number() over () as r, x, y from featured)", ONE_TRIAL, RIDGE)
FIT_OF_TRAIN = (FEATURED, """design as (
  select 0 as g, row_number() over () as r, x, y from featured, span where datetime_utc <= hi - interval 24 hour)""", ONE_TRIAL, RIDGE)
FITTED_STEP = {"value": f"a + list_dot_product(c, {features_sql('(t + interval 1 hour)')})", "beside": ", solved"}


# Three trees by hand over the 82 features, and the same as SQL.
HAND_TREES = (
    (1.0, {"feature": 0, "at_most": 400.0, "then": {"feature": 79, "at_most": 11.0, "then": 150.0, "other": 320.5},
           "other": {"feature": 72, "at_most": 900.0, "then": 610.25, "other": 1200.0}}),
    (0.1, {"feature": 76, "at_most": 250.0, "then": -75.0, "other": {"feature": 80, "at_most": 0.0, "then": 31.0, "other": 77.0}}),
    (0.1, {"feature": 23, "at_most": 300.0, "then": {"feature": 78, "at_most": 4.0, "then": -210.0, "other": 95.5}, "other": 125.0}),
)
HAND_TREES_SQL = """case when h[72] <= 400 then case when hour(t + interval 1 hour) <= 11 then 150.0 else 320.5 end
                          when list_avg(h[49:]) <= 900 then 610.25 else 1200.0 end::double
           + 0.1 * case when list_stddev_samp(h[25:]) <= 250 then -75.0 when area <= 0 then 31.0 else 77.0 end::double
           + 0.1 * case when h[49] > 300 then 125.0 when isodow(t + interval 1 hour) - 1 <= 4 then -210.0 else 95.5 end::double"""

STEP_PAIRS = """step_pairs as (
  select t.area, t.consumer_type, t.datetime_utc, t.energy_consumption as y, s.p
  from dense t join steps s on s.area = t.area and s.consumer_type = t.consumer_type and s.t = t.datetime_utc and s.step > 0
  where t.observed)"""


def recursive_sql(body: str, *more: str) -> str:
    return "with recursive " + dense_sql(body, *more)[len("with "):]


def ctes(*parts: str) -> str:
    return "with " + ",\n".join(parts) + "\n"


def panel_sql(body: str) -> str:
    return ctes(PANEL, SPAN) + body


def dense_sql(body: str, *more: str) -> str:
    return ctes(*BASE, *more) + body
