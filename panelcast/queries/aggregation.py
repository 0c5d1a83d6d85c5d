"""E: aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast import fixtures
from panelcast.operators import aggregates
from panelcast.operators.forecast import observed
from panelcast.operators.joins import pair
from panelcast.operators.timeseries import label_last_hours, seasonal_naive
from panelcast.plans import training
from panelcast.queries.registry import lists_as_text, query, rounded
from panelcast.queries.sql import APE, NEW, PAIRS, TRUTH, dense_sql, panel_sql

SEASONS = (24, 48, 168)

# Folds of n hours: step n // 3, first window max(72, step - 24).
FOLDS = """folds as (
  select cast(row_number() over (order by train_end) - 1 as integer) as fold, train_end, train_end + 24 as test_end
  from (select unnest(generate_series(greatest(72, n // 3 - 24), n - 24, n // 3)) as train_end
        from (select count(distinct datetime_utc) as n from dense)))"""
INDEXED = "indexed as (select d.*, date_diff('hour', lo, datetime_utc) as i from dense d, span)"
SEASON_TRIALS = f"""trials as (
  select s.config_id, s.season, f.fold, abs(a.energy_consumption - b.energy_consumption)
         / greatest(abs(a.energy_consumption), 2.220446049250313e-16) as ape
  from folds f join indexed a on a.i >= f.train_end and a.i < f.test_end and a.observed
  cross join (values (0, 24), (1, 48), (2, 168)) s(config_id, season)
  join indexed b on b.area = a.area and b.consumer_type = a.consumer_type and b.i = a.i - s.season),
results as (select config_id, season, fold, avg(ape) as "MAPE" from trials group by 1, 2, 3),
means as (select config_id, avg("MAPE") as "MAPE" from results group by 1)"""


def pairs(spark, sf_dir):
    train, test = training.split(fixtures.dense(spark, sf_dir))
    return pair(observed(test), seasonal_naive(train))


def season_results(spark, sf_dir):
    return training.season_trials(fixtures.dense(spark, sf_dir), SEASONS)


@query("e01_distinct_values", panel_sql("select distinct consumer_type from panel order by 1"))
def e01(spark, sf_dir):
    return aggregates.distinct_values(fixtures.panel(spark, sf_dir), "consumer_type")


@query("e02_time_span", panel_sql("select min(datetime_utc) as t_min, max(datetime_utc) as t_max from panel"))
def e02(spark, sf_dir):
    return aggregates.time_span(fixtures.panel(spark, sf_dir))


@query("e03_count_hours", panel_sql("select count(distinct datetime_utc) as hours from panel"))
def e03(spark, sf_dir):
    return aggregates.count_hours(fixtures.panel(spark, sf_dir))


@query("e04_split_profile", panel_sql("""
, ranked as (select *, row_number() over (partition by area, consumer_type order by datetime_utc desc) as r from panel)
select case when r <= 24 then 'test' else 'train' end as split, min(datetime_utc) as t_min, max(datetime_utc) as t_max,
       count(*) as dataset_size, count(distinct area) as num_areas, count(distinct consumer_type) as num_consumer_types,
       'energy_consumption' as y_features, '' as X_features
from ranked group by 1"""))
def e04(spark, sf_dir):
    profile = aggregates.split_profile(label_last_hours(fixtures.panel(spark, sf_dir)))
    return lists_as_text(profile, ("y_features", "X_features"))


@query("e05_rmspe", dense_sql(f'select round(sqrt(avg(pow({APE}, 2))), 6) as "RMSPE" from pairs', PAIRS))
def e05(spark, sf_dir):
    return rounded(aggregates.score(pairs(spark, sf_dir)).select("RMSPE"), "RMSPE")


@query("e06_mape", dense_sql(f'select round(avg({APE}), 6) as "MAPE" from pairs', PAIRS))
def e06(spark, sf_dir):
    return rounded(aggregates.score(pairs(spark, sf_dir)).select("MAPE"), "MAPE")


SLICES_SQL = dense_sql(f"""
select area, consumer_type, round(sqrt(avg(pow({APE}, 2))), 6) as "RMSPE", round(avg({APE}), 6) as "MAPE",
       false as overall from pairs group by 1, 2
union all
select cast(-1 as tinyint), -1, round(sqrt(avg(pow({APE}, 2))), 6), round(avg({APE}), 6), true from pairs""", PAIRS)


@query("e07_slice_metrics", SLICES_SQL)
def e07(spark, sf_dir):
    return slices(aggregates.score_slices(pairs(spark, sf_dir)))


def slices(scores):
    """Metrics as compared: six decimals, and -1 for the keys of the overall row."""
    keys = {"area": F.coalesce("area", F.lit(-1).cast("tinyint")), "consumer_type": F.coalesce("consumer_type", F.lit(-1))}
    return rounded(scores.withColumns(keys), "RMSPE", "MAPE")


@query("e08_mape_per_hour", dense_sql(f'select datetime_utc, round(avg({APE}), 6) as "MAPE" from pairs group by 1', PAIRS))
def e08(spark, sf_dir):
    return rounded(aggregates.mape_per_hour(pairs(spark, sf_dir)), "MAPE")


@query("e09_fold_means", dense_sql('select config_id, round("MAPE", 6) as "MAPE" from means', FOLDS, INDEXED, SEASON_TRIALS))
def e09(spark, sf_dir):
    return rounded(aggregates.mean_over_folds(season_results(spark, sf_dir)), "MAPE")


@query("e10_best_config", dense_sql("""
select config_id, round("MAPE", 6) as "MAPE" from means order by round(means."MAPE", 12), config_id limit 1""",
                                    FOLDS, INDEXED, SEASON_TRIALS))
def e10(spark, sf_dir):
    means = aggregates.mean_over_folds(season_results(spark, sf_dir))
    return rounded(aggregates.best_config(means), "MAPE")


def text_list(value: str, order: str = "datetime_utc") -> str:
    return f"string_agg(cast({value} as varchar), ',' order by {order})"


HOUR = "date_diff('hour', timestamp '1970-01-01', datetime_utc)"


def money_list(value: str) -> str:
    return text_list(f"cast({value} as decimal(18,2))")


@query("e11_series_arrays", panel_sql(f"""
select area, consumer_type,
       cast(floor(date_diff('hour', timestamp '1970-01-01', datetime_utc) / 168) as integer) as page,
       {text_list(HOUR)} as datetime_utc, {money_list('energy_consumption')} as energy_consumption
from panel group by 1, 2, 3"""))
def e11(spark, sf_dir):
    paged = aggregates.pages(fixtures.panel(spark, sf_dir), page_hours=168)
    return lists_as_text(paged, ("datetime_utc",), ("energy_consumption",))


@query("e11b_page_index", panel_sql("""
, paged as (
  select area, consumer_type, cast(floor(date_diff('hour', timestamp '1970-01-01', datetime_utc) / 168) as integer) as page,
         min(date_diff('hour', timestamp '1970-01-01', datetime_utc)) as first_hour, count(*) as rows
  from panel where datetime_utc >= timestamp '2024-01-10' group by 1, 2, 3)
select *, cast(coalesce(sum(rows) over (partition by area, consumer_type order by page rows between unbounded preceding and 1 preceding), 0) as bigint) as "offset"
from paged"""))
def e11b(spark, sf_dir):
    """The pages of a table whose old hours have left keep their numbers; the index finds a row by its place."""
    recent = fixtures.panel(spark, sf_dir).filter(F.col("datetime_utc") >= F.lit("2024-01-10").cast("timestamp_ntz"))
    return aggregates.page_index(aggregates.pages(recent, page_hours=168))


@query("e12_series_by_split", panel_sql(f"""
, labelled as (
  select p.*, case when row_number() over (partition by area, consumer_type order by datetime_utc desc) <= 24
              then 'y_test' else 'y_train' end as split,
         cast(floor(date_diff('hour', timestamp '1970-01-01', datetime_utc) / 8784) as integer) as page from panel p)
select area, consumer_type, page,
       coalesce({money_list('energy_consumption')} filter (where split = 'y_train'), '') as y_train,
       coalesce({money_list('energy_consumption')} filter (where split = 'y_test'), '') as y_test
from labelled group by 1, 2, 3"""))
def e12(spark, sf_dir):
    train, test = training.split(fixtures.panel(spark, sf_dir))
    labelled = aggregates.label_splits({"y_train": train, "y_test": test})
    return lists_as_text(
        aggregates.series_by_split(labelled, ("y_train", "y_test")), (), ("y_train", "y_test")
    )
