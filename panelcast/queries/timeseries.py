"""F, G, H: window and time-series operators, sorts, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast import fixtures
from panelcast.operators import clean, joins
from panelcast.operators import timeseries as ts
from panelcast.operators.aggregates import label_splits
from panelcast.plans.training import split
from panelcast.queries.aggregation import FOLDS, INDEXED
from panelcast.queries.registry import query, rounded
from panelcast.queries.sql import RAW, ctes, dense_sql, panel_sql
from panelcast.queries.storage import landed_payloads
from panelcast.schemas import OBSERVED, PANEL
from panelcast.session import scratch_path
from panelcast.sources import feature_store, feature_table
from panelcast.sources.landed import read_payloads

OVER = "over (partition by area, consumer_type order by datetime_utc"


@query("f01_lags", dense_sql(f"""
select *, lag(energy_consumption, 1) {OVER}) as lag_1, lag(energy_consumption, 24) {OVER}) as lag_24,
       lag(energy_consumption, 72) {OVER}) as lag_72 from dense"""))
def f01(spark, sf_dir):
    return ts.lags(fixtures.dense(spark, sf_dir), (1, 24, 72))


@query("f01b_lags_with_gaps", panel_sql("""
select p.*, a.energy_consumption as lag_1, b.energy_consumption as lag_24 from panel p
left join panel a on a.area = p.area and a.consumer_type = p.consumer_type
     and a.datetime_utc = p.datetime_utc - interval 1 hour
left join panel b on b.area = p.area and b.consumer_type = p.consumer_type
     and b.datetime_utc = p.datetime_utc - interval 24 hour"""))
def f01b(spark, sf_dir):
    return ts.lags(fixtures.panel(spark, sf_dir), (1, 24))


def _rolling_sql(function: str, prefix: str) -> str:
    columns = ",\n".join(
        f"""case when count(*) {OVER} rows between {n} preceding and 1 preceding) = {n} then
        round({function}(energy_consumption) {OVER} rows between {n} preceding and 1 preceding), 6) end as {prefix}_1_{n}"""
        for n in (24, 48, 72)
    )
    return dense_sql(f"select *, {columns} from dense")


@query("f02_rolling_mean", _rolling_sql("avg", "mean"))
def f02(spark, sf_dir):
    return rounded(ts.rolling_mean(fixtures.dense(spark, sf_dir)), "mean_1_24", "mean_1_48", "mean_1_72")


@query("f03_rolling_std", _rolling_sql("stddev_samp", "std"))
def f03(spark, sf_dir):
    return rounded(ts.rolling_std(fixtures.dense(spark, sf_dir)), "std_1_24", "std_1_48", "std_1_72")


@query("f04_full_history", dense_sql(f"""
select * from (
  select area, consumer_type, datetime_utc, energy_consumption,
         string_agg(cast(cast(energy_consumption as decimal(18,2)) as varchar), ',')
           {OVER} rows between 72 preceding and 1 preceding) as history,
         row_number() {OVER}) as r from dense) where r > 72""").replace("select * from (\n  select", "select * exclude (r) from (\n  select"))
def f04(spark, sf_dir):
    full = ts.full_history(ts.history(fixtures.dense(spark, sf_dir).drop(OBSERVED)))
    money = F.transform("history", lambda x: x.cast("decimal(18,2)").cast("string"))
    return full.withColumn("history", F.array_join(money, ","))


STORED_STATISTICS = ",\n".join(
    f"round({function}(energy_consumption) {OVER} rows between {n} preceding and 1 preceding), 6) as {name}_1_{n}"
    for function, name in (("avg", "mean"), ("stddev_samp", "std")) for n in (24, 48, 72)
)


@query("f04c_stored_features", dense_sql(f"""
select * exclude (r) from (
  select area, consumer_type, datetime_utc, isodow(datetime_utc) - 1 as day_of_week, hour(datetime_utc) as hour_of_day,
         string_agg(cast(cast(energy_consumption as decimal(18,2)) as varchar), ',') {OVER} rows between 72 preceding and 1 preceding) as history,
         {STORED_STATISTICS}, 4 as days_made, row_number() {OVER}) as r
  from (select area, consumer_type, datetime_utc, energy_consumption
               + case when cast(datetime_utc as date) = cast(hi as date) - 8 then 1 else 0 end as energy_consumption from dense, span))
where r > 72"""))
def f04c(spark, sf_dir):
    """All look-back features from the store: days ingested in two batches, then one day corrected late. ``days_made`` are the
    days that the correction made anew, itself and the three that its hours reach."""
    table = scratch_path(spark, "feature-store")
    dense = fixtures.dense(spark, sf_dir).select(*PANEL.names)
    last = dense.agg(F.max(F.to_date("datetime_utc"))).scalar()
    day = F.to_date("datetime_utc")
    for batch in (dense.filter(day < F.date_add(last, -2)), dense.filter(day >= F.date_add(last, -2))):
        feature_table.upsert(spark, table, batch)
        feature_store.refresh(spark, table)
    late = dense.filter(day == F.date_add(last, -8)).withColumn("energy_consumption", F.col("energy_consumption") + 1)
    feature_table.upsert(spark, table, late)
    made = feature_store.refresh(spark, table)
    statistics = [f"{name}_1_{n}" for name in ("mean", "std") for n in (24, 48, 72)]
    money = F.transform(F.reverse(F.slice("window", 1, 72)), lambda x: x.cast("decimal(18,2)").cast("string"))
    return feature_store.read_features(spark, table).select(
        "area", "consumer_type", "datetime_utc", "day_of_week", "hour_of_day", F.array_join(money, ",").alias("history"),
        *[F.round(F.element_at("window", 73 + i), 6).alias(c) for i, c in enumerate(statistics)], F.lit(len(made)).alias("days_made"))


@query("f01c_stored_lags_with_gaps", panel_sql("""
select p.*, a.energy_consumption as lag_1, b.energy_consumption as lag_24, c.energy_consumption as lag_72 from panel p
left join panel a on a.area = p.area and a.consumer_type = p.consumer_type and a.datetime_utc = p.datetime_utc - interval 1 hour
left join panel b on b.area = p.area and b.consumer_type = p.consumer_type and b.datetime_utc = p.datetime_utc - interval 24 hour
left join panel c on c.area = p.area and c.consumer_type = p.consumer_type and c.datetime_utc = p.datetime_utc - interval 72 hour"""))
def f01c(spark, sf_dir):
    """Lags of a table with gaps from the store; the rows of one hour of every day arrive late, as layers."""
    table = scratch_path(spark, "lag-store")
    features = feature_store.Features(lags=(1, 24, 72), means=(), stds=(), with_calendar=False, full=False)
    panel, late = fixtures.panel(spark, sf_dir), F.hour("datetime_utc") == 5
    feature_table.upsert(spark, table, panel.filter(~late))
    feature_store.refresh(spark, table, features)
    feature_table.upsert(spark, table, panel.filter(late), merge=False)
    feature_store.refresh(spark, table, features)
    return feature_store.read_features(spark, table, features)


@query("f05_calendar", panel_sql("""
select *, cast(isodow(datetime_utc) - 1 as integer) as day_of_week, cast(hour(datetime_utc) as integer) as hour_of_day
from panel"""))
def f05(spark, sf_dir):
    return ts.calendar(fixtures.panel(spark, sf_dir))


@query("f06_last_hours_split", panel_sql(f"""
select *, case when row_number() {OVER} desc) <= 24 then 'test' else 'train' end as split from panel"""))
def f06(spark, sf_dir):
    return ts.label_last_hours(fixtures.panel(spark, sf_dir))


@query("f07_expanding_folds", dense_sql("""
select f.fold, case when i < f.train_end then 'train' else 'test' end as split,
       x.area, x.consumer_type, x.datetime_utc, x.energy_consumption
from indexed x join folds f on x.i < f.test_end""", FOLDS, INDEXED))
def f07(spark, sf_dir):
    return ts.label_folds(fixtures.dense(spark, sf_dir).drop(OBSERVED))


@query("f07b_fold_bounds", dense_sql("select fold, lo as origin, train_end, test_end from folds, span", FOLDS))
def f07b(spark, sf_dir):
    return ts.fold_bounds(fixtures.dense(spark, sf_dir))


@query("f08_horizon_steps", panel_sql("""
select area, consumer_type, cast(s as integer) as step
from (select distinct area, consumer_type from panel), range(1, 25) t(s)"""))
def f08(spark, sf_dir):
    return ts.horizon_steps(fixtures.panel(spark, sf_dir))


@query("f09_shift_hours", panel_sql("""
select datetime_utc + interval 24 hour as datetime_utc, area, consumer_type from panel"""))
def f09(spark, sf_dir):
    return ts.shift_hours(clean.split_target(fixtures.panel(spark, sf_dir))[0], 24)


@query("f10_seasonal_naive", panel_sql("""
, ends as (select area, consumer_type, max(datetime_utc) as hi from panel group by 1, 2)
select p.area, p.consumer_type, p.datetime_utc + to_hours(cast(24 * j as integer)) as datetime_utc, p.energy_consumption
from panel p join ends e using (area, consumer_type), range(1, 4) r(j)
where p.datetime_utc > e.hi - interval 24 hour and p.datetime_utc + to_hours(cast(24 * j as integer)) <= e.hi + interval 60 hour"""))
def f10(spark, sf_dir):
    return ts.seasonal_naive(fixtures.panel(spark, sf_dir), 60, 24)


@query("f11_newest_week", panel_sql(f"""
select datetime_utc, area, consumer_type, energy_consumption from (
  select *, row_number() {OVER} desc) as r from panel) where r <= 168"""))
def f11(spark, sf_dir):
    return ts.newest(fixtures.panel(spark, sf_dir), 168)


@query("f12_future_hours", panel_sql("""
select area, consumer_type, hi + to_hours(cast(s as integer)) as datetime_utc
from (select distinct area, consumer_type from panel), span, range(1, 25) t(s)"""))
def f12(spark, sf_dir):
    panel = fixtures.panel(spark, sf_dir)
    return panel.select("area", "consumer_type").distinct().transform(joins.attach_hours, panel, 24)


@query("g01_sort_rows", panel_sql("""
select datetime_utc, area, consumer_type, energy_consumption from panel order by area, consumer_type, datetime_utc"""))
def g01(spark, sf_dir):
    return clean.sort_rows(fixtures.panel(spark, sf_dir))


@query("g02_source_sort", ctes(RAW) + 'select * from raw order by "HourUTC"')
def g02(spark, sf_dir):
    return read_payloads(spark, landed_payloads(spark, sf_dir), sort_by="HourUTC")


@query("h01_append", dense_sql("select * from dense order by area, consumer_type, datetime_utc"))
def h01(spark, sf_dir):
    return ts.append_sorted(*split(fixtures.dense(spark, sf_dir)))


@query("h02_labelled_union", dense_sql("""
select area, consumer_type, datetime_utc, energy_consumption,
       case when datetime_utc > hi - interval 24 hour then 'y_test' else 'y_train' end as split from dense, span
union all
select area, consumer_type, datetime_utc + interval 24 hour, energy_consumption, 'y_pred'
from dense, span where datetime_utc > hi - interval 48 hour and datetime_utc <= hi - interval 24 hour"""))
def h02(spark, sf_dir):
    train, test = split(fixtures.dense(spark, sf_dir).drop(OBSERVED))
    return label_splits({"y_train": train, "y_test": test, "y_pred": ts.seasonal_naive(train)})
