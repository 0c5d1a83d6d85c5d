"""K: pooled forecasting."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from panelcast import fixtures
from panelcast.operators import forecast as fc
from panelcast.operators.aggregates import best_config, mean_over_folds, score_slices
from panelcast.operators.timeseries import label_folds, lags
from panelcast.operators.trees import FlatTrees
from panelcast.plans import prediction, training
from panelcast.queries.aggregation import FOLDS, INDEXED, SEASON_TRIALS, SLICES_SQL, season_results, slices
from panelcast.queries.registry import query, rounded
from panelcast.queries.sql import (
    APE, CONSTANT, FEATURED, FIT_OF_ALL, FIT_OF_TRAIN, FITTED_STEP, FIXED_COEFFICIENTS, HAND_TREES, HAND_TREES_SQL, LAGGED, LINE, LINE_OF_ALL, LINE_OF_TRAIN, LINE_PAIRS, NEXT_FORECAST, PAIRS, RIDGE, STEP_PAIRS, TEST_FORECAST,
    dense_sql, features_sql, panel_sql, recursion, recursive_sql,
)
from panelcast.queries.timeseries import OVER
from panelcast.schemas import KEYS, TIME
from panelcast.session import scratch_path


def fitted(spark, sf_dir, config=None):
    train, test = training.split(fixtures.dense(spark, sf_dir))
    return fc.fit(train, config), train, test


#: All 82 features with weights that SQL knows.
FIXED = fc.LinearForecaster(FIXED_COEFFICIENTS, CONSTANT)
BEFORE_TEST = "hi - interval 24 hour"
#: A gradient this close to 0, in units of deviations, is that of a solution.
SOLVED = 1e-7


@query("k01_feature_stages", dense_sql(f"""
select area, consumer_type, datetime_utc, energy_consumption, lag_1, lag_72, mean_24, mean_72, std_24, std_72,
       cast(isodow(datetime_utc) - 1 as double) as day_of_week, cast(hour(datetime_utc) as double) as hour_of_day,
       cast(area as double) as area_exog, cast(consumer_type as double) as consumer_type_exog
from (select *, lag(energy_consumption, 1) {OVER}) as lag_1, lag(energy_consumption, 72) {OVER}) as lag_72,
        round(avg(energy_consumption) {OVER} rows between 24 preceding and 1 preceding), 6) as mean_24,
        round(avg(energy_consumption) {OVER} rows between 72 preceding and 1 preceding), 6) as mean_72,
        round(stddev_samp(energy_consumption) {OVER} rows between 24 preceding and 1 preceding), 6) as std_24,
        round(stddev_samp(energy_consumption) {OVER} rows between 72 preceding and 1 preceding), 6) as std_72
      from dense) where lag_72 is not null"""))
def k01(spark, sf_dir):
    ready = fc.features_of(fixtures.dense(spark, sf_dir))
    x = vector_to_array("features")
    places = {
        "lag_1": 0, "lag_72": 71, "mean_24": 72, "mean_72": 74, "std_24": 75, "std_72": 77,
        "day_of_week": 78, "hour_of_day": 79, "area_exog": 80, "consumer_type_exog": 81,
    }
    wide = ready.withColumn("_x", x).select(
        *KEYS, TIME, "energy_consumption", *[F.col("_x")[i].alias(n) for n, i in places.items()]
    )
    return rounded(wide, "mean_24", "mean_72", "std_24", "std_72")


@query("k02_pooled_fit", dense_sql("""
select cast(f as integer) as feature, true as solved, (select count(*) from dense, span where datetime_utc <= hi - interval 24 hour) as rows_trained,
       (select count(*) from dense, span where datetime_utc <= hi - interval 24 hour and datetime_utc >= lo + interval 72 hour) as rows_with_history
from range(82) t(f)"""))
def k02(spark, sf_dir):
    """The fit over all 82 features. ``solved`` says that a feature's normal equation holds for the fitted coefficients: it is
    taken from second moments that are gathered apart from the fit."""
    model, train, _ = fitted(spark, sf_dir)
    state = fc.moments_of(train)
    gradient = state.gradient(model.stages[-1].coefficients.toArray(), fc.effective({})["reg_lambda"])
    rows = [(i, bool(abs(g) < SOLVED), int(state.n)) for i, g in enumerate(gradient)]
    return spark.createDataFrame(rows, "feature int, solved boolean, rows_with_history long").withColumn(
        "rows_trained", train.agg(F.count(F.lit(1))).scalar())


@query("k02d_line_fit", dense_sql("""
select 0 as feature, round(b, 6) as weight, (select count(*) from dense, span where datetime_utc <= hi - interval 24 hour) as rows_trained from line
union all
select -1, round(a, 6), (select count(*) from dense, span where datetime_utc <= hi - interval 24 hour) from line""", LAGGED, LINE_OF_TRAIN))
def k02d(spark, sf_dir):
    model, train, _ = fitted(spark, sf_dir, LINE)
    learner = model.stages[-1]
    terms = [(i, round(float(c), 6)) for i, c in enumerate(learner.coefficients)] + [(-1, round(float(learner.intercept), 6))]
    return spark.createDataFrame(terms, "feature int, weight double").withColumn(
        "rows_trained", train.agg(F.count(F.lit(1))).scalar()
    )


@query("k02b_lag_regression", dense_sql(f"""
select round(regr_slope(energy_consumption, l), 6) as slope, round(regr_intercept(energy_consumption, l), 6) as intercept,
       cast(regr_count(energy_consumption, l) as bigint) as n
from (select energy_consumption, lag(energy_consumption, 24) {OVER}) as l from dense)"""))
def k02b(spark, sf_dir):
    lagged = lags(fixtures.dense(spark, sf_dir), (24,))
    return rounded(fc.lag_regression(lagged, "lag_24"), "slope", "intercept")


@query("k02c_boosted_trees_fit", dense_sql("""
select k.area, k.consumer_type, hi - interval 24 hour + to_hours(cast(s as integer)) as datetime_utc, true as finite
from (select distinct area, consumer_type from panel) k, span, range(1, 25) t(s)"""))
def k02c(spark, sf_dir):
    """Trees have no SQL: it states keys, hours and that all values are finite; a test checks the values."""
    model, train, _ = fitted(spark, sf_dir, {"learner": "trees", "n_estimators": 5, "max_depth": 4})
    finite = F.col("energy_consumption").isNotNull() & (F.abs("energy_consumption") < float("inf"))
    return fc.forecast(model, train).select(*KEYS, TIME, F.coalesce(finite, F.lit(False)).alias("finite"))


@query("k03_recursive_forecast", recursive_sql("""
select area, consumer_type, t as datetime_utc, round(p, 6) as energy_consumption from steps where step > 0""", recursion(BEFORE_TEST)))
def k03(spark, sf_dir):
    """24 steps over all 82 features, each value fed back; the weights are fixed, so that SQL can follow."""
    train, _ = training.split(fixtures.dense(spark, sf_dir))
    return rounded(fc.forecast(FIXED, train), "energy_consumption")


@query("k03d_fitted_forecast", dense_sql("""
select k.area, k.consumer_type, hi - interval 24 hour + to_hours(cast(s as integer)) as datetime_utc, true as same
from (select distinct area, consumer_type from panel) k, span, range(1, 25) t(s)"""))
def k03d(spark, sf_dir):
    """Fits over all 82 features by the library's learner and by normal equations; ``same`` says that their forecasts agree."""
    model, train, _ = fitted(spark, sf_dir, {"reg_lambda": 0.01})
    solved = fc.forecast(fc.solve(train, {"reg_lambda": 0.01}), train).withColumnRenamed("energy_consumption", "other")
    close = F.abs(F.col("energy_consumption") - F.col("other")) < 1e-6
    return fc.forecast(model, train).join(solved, [*KEYS, TIME]).select(*KEYS, TIME, F.coalesce(close, F.lit(False)).alias("same"))


@query("k03f_tree_recursion", recursive_sql("""
select area, consumer_type, t as datetime_utc, round(p, 6) as energy_consumption from steps where step > 0""", recursion(BEFORE_TEST, value=HAND_TREES_SQL)))
def k03f(spark, sf_dir):
    """24 steps of three trees made by hand over all 82 features, each value fed back."""
    train, _ = training.split(fixtures.dense(spark, sf_dir))
    return rounded(fc.forecast(fc.TreeForecaster(FlatTrees.of_nodes(HAND_TREES)), train), "energy_consumption")


@query("k03e_line_forecast", dense_sql(TEST_FORECAST, LAGGED, LINE_OF_TRAIN))
def k03e(spark, sf_dir):
    model, train, _ = fitted(spark, sf_dir, LINE)
    return rounded(fc.forecast(model, train), "energy_consumption")


@query("k03b_lag_recursion", dense_sql(f"""
, pairs as (select energy_consumption as y, lag(energy_consumption, 24) {OVER}) as l from dense),
fit as (select regr_slope(y, l) as b, regr_intercept(y, l) as a from pairs)
select d.area, d.consumer_type, d.datetime_utc + to_hours(cast(24 * j as integer)) as datetime_utc,
       round(case j when 1 then a + b * energy_consumption when 2 then a + b * (a + b * energy_consumption)
             else a + b * (a + b * (a + b * energy_consumption)) end, 6) as energy_consumption
from dense d, span, fit, range(1, 4) r(j) where d.datetime_utc > hi - interval 24 hour"""))
def k03b(spark, sf_dir):
    """The general recursion with all weight on lag 24: 72 steps, so each value feeds the next day."""
    dense = fixtures.dense(spark, sf_dir)
    line = fc.lag_regression(lags(dense, (24,)), "lag_24")
    zero = F.array(F.lit(0.0), F.lit(0.0))
    weights = line.select(
        F.concat(F.array("slope"), F.array_repeat(F.lit(0.0), 23)).alias("lag"), zero.alias("std"),
        zero.alias("calendar"), zero.alias("key"), "intercept",
    )
    done = fc.forecast_with(fc.latest_history(dense, 24), weights, (), 72)
    return rounded(fc.as_rows(done, 72), "energy_consumption")


def _slices_of(pairs: str) -> str:
    return SLICES_SQL[SLICES_SQL.rindex("select area"):SLICES_SQL.rindex("from pairs")].replace("from pairs", f"from {pairs}") + f"from {pairs}"


@query("k04_evaluate", recursive_sql(_slices_of("step_pairs"), recursion(BEFORE_TEST), STEP_PAIRS))
def k04(spark, sf_dir):
    train, test = training.split(fixtures.dense(spark, sf_dir))
    return slices(score_slices(fc.evaluate(FIXED, train, test)))


@query("k04c_evaluate_line", dense_sql(_slices_of("line_pairs"), LAGGED, LINE_OF_TRAIN, LINE_PAIRS))
def k04c(spark, sf_dir):
    model, train, test = fitted(spark, sf_dir, LINE)
    return slices(score_slices(fc.evaluate(model, train, test)))


@query("k04b_evaluate_baseline", SLICES_SQL)
def k04b(spark, sf_dir):
    train, test = training.split(fixtures.dense(spark, sf_dir))
    return slices(score_slices(training.baseline_pairs(train, test)))


@query("k05_compare_with_baseline", recursive_sql(f"""
select 'model' as model, round(sqrt(avg(pow({APE}, 2))), 6) as "RMSPE", round(avg({APE}), 6) as "MAPE" from step_pairs
union all
select 'baseline', round(sqrt(avg(pow({APE}, 2))), 6), round(avg({APE}), 6) from pairs""", PAIRS, *FIT_OF_TRAIN, recursion(BEFORE_TEST, **FITTED_STEP), STEP_PAIRS))
def k05(spark, sf_dir):
    """The model is fitted over all 82 features; SQL solves its normal equations."""
    model, train, test = fitted(spark, sf_dir, {"reg_lambda": 0.01})
    return rounded(training.compare_with_baseline(model, train, test), "RMSPE", "MAPE")


@query("k05b_compare_line_with_baseline", dense_sql(f"""
select 'model' as model, round(sqrt(avg(pow({APE}, 2))), 6) as "RMSPE", round(avg({APE}), 6) as "MAPE" from line_pairs
union all
select 'baseline', round(sqrt(avg(pow({APE}, 2))), 6), round(avg({APE}), 6) from pairs""", PAIRS, LAGGED, LINE_OF_TRAIN, LINE_PAIRS))
def k05b(spark, sf_dir):
    model, train, test = fitted(spark, sf_dir, LINE)
    return rounded(training.compare_with_baseline(model, train, test), "RMSPE", "MAPE")


@query("k06_refit_and_forecast", recursive_sql("""
select area, consumer_type, t as datetime_utc, round(p, 4) as energy_consumption, true as same from steps where step > 0""",
                                               *FIT_OF_ALL, recursion("hi", **FITTED_STEP)))
def k06(spark, sf_dir):
    """Forecasts of the refit on all hours over all 82 features, whose normal equations SQL solves; ``same`` compares them with
    those of the solved equations."""
    train, test = training.split(fixtures.dense(spark, sf_dir))
    refitted = training.refit_and_forecast(train, test, {"reg_lambda": 0.01})[1]
    everything = train.unionByName(test)
    solved = fc.forecast(fc.solve(everything, {"reg_lambda": 0.01}), everything).withColumnRenamed("energy_consumption", "other")
    close = F.abs(F.col("energy_consumption") - F.col("other")) < 1e-6
    return refitted.join(solved, [*KEYS, TIME]).select(
        *KEYS, TIME, F.round("energy_consumption", 4).alias("energy_consumption"), F.coalesce(close, F.lit(False)).alias("same"))


@query("k06b_refit_line_and_forecast", dense_sql(NEXT_FORECAST, LAGGED, LINE_OF_ALL))
def k06b(spark, sf_dir):
    train, test = training.split(fixtures.dense(spark, sf_dir))
    return rounded(training.refit_and_forecast(train, test, LINE)[1], "energy_consumption")


@query("k07_grid_of_trials", dense_sql("""
, sizes as (
  select f.fold, count(*) filter (where i < f.train_end) as train_rows,
         count(*) filter (where i >= f.train_end) as test_rows
  from indexed x join folds f on x.i < f.test_end group by 1),
grid as (
  select cast(((pn * 2 + pl) * 2 + pd) * 3 + pr as integer) as config_id, n_estimators, learning_rate, max_depth, reg_lambda
  from (values (0, 1000), (1, 2000), (2, 2500)) a(pn, n_estimators),
       (values (0, cast(0.1 as double)), (1, cast(0.15 as double))) b(pl, learning_rate),
       (values (0, -1), (1, 5)) c(pd, max_depth),
       (values (0, cast(0 as double)), (1, cast(0.01 as double)), (2, cast(0.015 as double))) d(pr, reg_lambda))
select * from sizes, grid""", FOLDS, INDEXED))
def k07(spark, sf_dir):
    return fc.trial_plan(label_folds(fixtures.dense(spark, sf_dir)))


FOLDS_OF_TRAIN = """
, train as (select x.* from indexed x, span where datetime_utc <= hi - interval 24 hour),
folds_of_train as (
  select cast(row_number() over (order by train_end) - 1 as integer) as fold, train_end, train_end + 24 as test_end
  from (select unnest(generate_series(greatest(72, n // 3 - 24), n - 24, n // 3)) as train_end
        from (select count(distinct datetime_utc) as n from train)))"""


# The second set of windows has all features but the deviation of 72 hours.
SEARCH = f"""design as (
  select fold * 2 + s as g, row_number() over () as r, case s when 0 then x else list_concat(x[:77], x[79:]) end as x, y
  from featured join train using (area, consumer_type, datetime_utc), folds_of_train, range(2) a(s) where i < train_end),
trials as (
  select fold * 6 + s * 3 + r as trial, fold * 2 + s as g, [1e-6, 0.01, 0.015][r + 1] as penalty, cast(s * 3 + r as integer) as config_id, fold, train_end, s
  from folds_of_train, range(2) a(s), range(3) b(r)),
{RIDGE},
steps(trial, area, consumer_type, t, step, h, p) as (
  select trial, area, consumer_type, max(datetime_utc), 0, list(energy_consumption order by datetime_utc), cast(null as double)
  from trials join train on i < train_end and i >= train_end - 72 group by trial, area, consumer_type
  union all
  select trial, area, consumer_type, t + interval 1 hour, step + 1, list_append(h[2:], v), v from (
    select *, a + list_dot_product(c, case s when 0 then x else list_concat(x[:77], x[79:]) end) as v
    from (select *, {features_sql('(t + interval 1 hour)')} as x from steps where step < 24) join solved using (trial) join trials using (trial))),
errors as (
  select trial, avg(abs(y - p) / greatest(abs(y), 2.220446049250313e-16)) as ape
  from (select d.area, d.consumer_type, d.datetime_utc, d.energy_consumption as y from train d where observed) q
  join steps on steps.area = q.area and steps.consumer_type = q.consumer_type and t = q.datetime_utc and step > 0 group by trial)"""


@query("k08_cross_validated_search", recursive_sql(FOLDS_OF_TRAIN + ",\n" + SEARCH + """
select config_id, fold, penalty as reg_lambda, count(*) as train_rows, true as solved, true as finite, round(any_value(ape), 6) as "MAPE"
from trials join design using (g) join errors using (trial) group by config_id, fold, penalty""", INDEXED, FEATURED))
def k08(spark, sf_dir):
    """All penalties and both sets of windows over all features. SQL solves the equations of every trial and follows its
    forecasts; ``solved`` says that the normal equations hold for the coefficients."""
    train, _ = training.split(fixtures.dense(spark, sf_dir))
    grid = [{**c, "std": std} for std in (fc.STD_WINDOWS, fc.GRID_STD_WINDOWS) for c in fc.grid_configs({"reg_lambda": fc.GRID["reg_lambda"]})]
    grid = [{**c, "config_id": i} for i, c in enumerate(grid)]
    solved: dict = {}
    results = fc.cross_validate(train, grid, solved=solved)
    rows = [(c, f, p, int(state.n), bool(abs(state.gradient(weights, p)).max() < SOLVED)) for (c, f), (weights, p, state) in solved.items()]
    trials = spark.createDataFrame(rows, "config_id int, fold int, reg_lambda double, train_rows long, solved boolean")
    return trials.join(results.select("config_id", "fold", (F.col("MAPE") < float("inf")).alias("finite"), F.round("MAPE", 6).alias("MAPE")), ["config_id", "fold"])


@query("k08c_search_of_lines", dense_sql(FOLDS_OF_TRAIN + f""",
trials as (
  select cast(s * 3 + r as integer) as config_id, season, penalty
  from (values (0, 24), (1, 48), (2, 168)) a(s, season), (values (0, 0.0), (1, 0.01), (2, 0.015)) b(r, penalty)),
earlier as (
  select s.config_id, s.penalty, a.area, a.consumer_type, a.i, a.observed, a.energy_consumption as y, b.energy_consumption as l
  from train a, trials s join train b on b.area = a.area and b.consumer_type = a.consumer_type and b.i = a.i - s.season),
lines as (
  select config_id, fold, regr_slope(y, l) / (1 + any_value(penalty) / stddev_pop(y)) as b, avg(y) as my, avg(l) as ml
  from earlier join folds_of_train on i < train_end group by 1, 2)
select config_id, fold, round(avg(abs(y - (my + b * (l - ml))) / greatest(abs(y), 2.220446049250313e-16)), 6) as "MAPE"
from earlier join folds_of_train on i >= train_end and i < test_end join lines using (config_id, fold)
where observed group by 1, 2""", INDEXED))
def k08c(spark, sf_dir):
    """Three sets of features, each a search of its own lag, with all penalties."""
    train, _ = training.split(fixtures.dense(spark, sf_dir))
    grid = [{**LINE, "lag": (season,), "reg_lambda": p} for season in (24, 48, 168) for p in fc.GRID["reg_lambda"]]
    results = fc.cross_validate(train, [{**c, "config_id": i} for i, c in enumerate(grid)])
    return results.select("config_id", "fold", F.round("MAPE", 6).alias("MAPE"))


@query("k08b_tree_grid", dense_sql("""
select config_id, fold, n_estimators, max_depth, true as finite
from (values (0, 3, 2), (1, 3, 4), (2, 6, 2), (3, 6, 4)) c(config_id, n_estimators, max_depth),
     (select fold from folds) f""", FOLDS))
def k08b(spark, sf_dir):
    """Trees have no SQL: it states the trials, their settings, and that all errors are finite; a test checks the values."""
    grid = fc.grid_configs({"learner": ["trees"], "n_estimators": [3, 6], "max_depth": [2, 4]})
    results = fc.cross_validate(fixtures.dense(spark, sf_dir), grid)
    used = F.from_json("config", "n_estimators int, max_depth int")
    return results.select("config_id", "fold", used.alias("c"), (F.col("MAPE") >= 0).alias("finite")).select("config_id", "fold", "c.*", "finite")


@query("k09_publish_best_config", dense_sql("""
select config_id, round("MAPE", 6) as "MAPE" from means order by round(means."MAPE", 12), config_id limit 1""",
                                            FOLDS, INDEXED, SEASON_TRIALS))
def k09(spark, sf_dir):
    root = scratch_path(spark, "best-config")
    best = best_config(mean_over_folds(season_results(spark, sf_dir)))
    training.publish_best(rounded(best, "MAPE"), root)
    return training.read_best(spark, root, "config_id int, MAPE double")


@query("k10_forecast_inputs", panel_sql("""
select a.area, c.consumer_type, hi + to_hours(cast(s as integer)) as datetime_utc,
       a.area as area_exog, c.consumer_type as consumer_type_exog
from (select distinct area from panel) a, (select distinct consumer_type from panel) c, span, range(1, 25) t(s)"""))
def k10(spark, sf_dir):
    return prediction.forecast_inputs(fixtures.panel(spark, sf_dir))
