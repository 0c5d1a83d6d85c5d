import statistics

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from panelcast.operators import aggregates, joins, timeseries as ts
from panelcast.functions.hours import day_of_week, hour_of_day
from panelcast.plans.training import split
from panelcast.schemas import EPSILON


def by_hour(df, column):
    return {(r["area"], r["datetime_utc"]): r[column] for r in df.collect()}


def test_lags_count_hours_not_rows(make_panel, hour):
    got = by_hour(ts.lags(make_panel({(0, 111): [(0, 1.0), (1, 2.0), (3, 4.0)]}), (1, 2)), "lag_1")
    assert got[0, hour(1)] == 1.0 and got[0, hour(3)] is None and got[0, hour(0)] is None


def test_rolling_excludes_the_current_row(make_panel, hour):
    panel = make_panel({(0, 111): [(h, float(h + 1)) for h in range(4)]})
    assert by_hour(ts.rolling_mean(panel, ((1, 3),)), "mean_1_3")[0, hour(3)] == 2.0
    assert by_hour(ts.rolling_std(panel, ((1, 3),)), "std_1_3")[0, hour(3)] == 1.0
    assert by_hour(ts.rolling_mean(panel, ((1, 3),)), "mean_1_3")[0, hour(2)] is None


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(3, 40), st.lists(st.integers(0, 200), min_size=1, max_size=80, unique=True))
def test_buckets_do_not_change_look_back(make_panel, hour, bucket, hours):
    """Windows cut into buckets see the same past as the whole series."""
    points = {h: float(h % 17) for h in hours}
    panel = make_panel({(0, 111): list(points.items()), (1, 111): list(points.items())})
    columns = {
        "n": F.count("energy_consumption").over(ts.hours_before(1, 3)),
        "s": F.sum("energy_consumption").over(ts.hours_before(1, 3)),
    }
    got = ts.look_back(panel, columns, 3, bucket_hours=bucket).collect()
    assert len(got) == 2 * len(hours)
    for row in got:
        h = int((row["datetime_utc"] - hour(0)).total_seconds() // 3600)
        past = [points[x] for x in (h - 3, h - 2, h - 1) if x in points]
        assert row["n"] == len(past) and (row["s"] or 0.0) == sum(past)


def test_a_long_series_is_many_small_windows(make_panel):
    panel = make_panel({(0, 111): [(h, 1.0) for h in range(5000)]})
    groups = ts.bucketed(panel, 72).groupBy("area", "consumer_type", "_bucket").count()
    assert groups.count() >= 7 and groups.agg(F.max("count")).first()[0] <= ts.BUCKET_HOURS + 72


def test_first_rows_lack_history(make_panel):
    panel = make_panel({(0, 111): [(h, float(h)) for h in range(100)]})
    full = ts.full_history(ts.history(panel))
    assert full.count() == 28
    first = full.orderBy("datetime_utc").first()
    assert first["history"] == [float(h) for h in range(72)]


def test_calendar(make_panel):
    row = make_panel({(0, 111): [(5, 1.0)]}).select(day_of_week("datetime_utc").alias("d"), hour_of_day("datetime_utc").alias("h")).first()
    assert (row["d"], row["h"]) == (0, 5)


def test_last_rows_are_the_test_split(make_panel, hour):
    panel = make_panel({(0, 111): [(h, 1.0) for h in range(5)], (1, 111): [(0, 1.0), (7, 1.0), (9, 1.0)]})
    got = by_hour(ts.label_last_hours(panel, 2), "split")
    assert {k for k, v in got.items() if v == "test"} == {(0, hour(3)), (0, hour(4)), (1, hour(7)), (1, hour(9))}
    assert len(got) == 8


def test_fold_arithmetic(make_panel):
    panel = make_panel({(0, 111): [(h, 1.0) for h in range(696)]})
    folds = ts.fold_bounds(panel, 24, 3).orderBy("fold").collect()
    assert [(f["train_end"], f["test_end"]) for f in folds] == [(208, 232), (440, 464), (672, 696)]
    counts = {
        (r["fold"], r["split"]): r["count"]
        for r in ts.label_folds(panel, 24, 3).groupBy("fold", "split").count().collect()
    }
    assert counts == {
        (0, "train"): 208, (0, "test"): 24, (1, "train"): 440, (1, "test"): 24, (2, "train"): 672, (2, "test"): 24,
    }


def test_too_few_hours_for_folds(make_panel):
    with pytest.raises(Exception, match="too few hours"):
        ts.fold_bounds(make_panel({(0, 111): [(h, 1.0) for h in range(239)]}), 24, 3).collect()


def test_seasonal_naive_repeats(make_panel, hour):
    panel = make_panel({(0, 111): [(0, 1.0), (1, 7.0), (2, 9.0)]})
    got = by_hour(ts.seasonal_naive(panel, 3, 2), "energy_consumption")
    assert got == {(0, hour(3)): 7.0, (0, hour(4)): 9.0, (0, hour(5)): 7.0}


def test_newest_rows(make_panel, hour):
    panel = make_panel({(0, 111): [(h, float(h)) for h in range(200)]})
    kept = ts.newest(panel, 168)
    assert kept.count() == 168 and kept.agg(F.min("datetime_utc")).first()[0] == hour(32)
    assert "WindowGroupLimit" in kept._jdf.queryExecution().toString()


def test_fill_hours(make_panel, hour):
    panel = make_panel({(0, 111): [(0, 1.0), (3, 4.0)], (1, 111): [(30, None)]})
    got = by_hour(joins.fill_hours(panel), "energy_consumption")
    assert got == {(0, hour(0)): 1.0, (0, hour(1)): None, (0, hour(2)): None, (0, hour(3)): 4.0, (1, hour(30)): None}
    assert by_hour(joins.fill_hours(panel, fill=0.0), "energy_consumption")[1, hour(30)] == 0.0
    assert joins.fill_hours(panel, span="table").count() == 62


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 100), min_size=1, max_size=30, unique=True))
def test_filled_series_has_every_hour(make_panel, hours):
    panel = make_panel({(0, 111): [(h, 1.0) for h in hours]})
    filled = joins.fill_hours(panel)
    assert filled.count() == max(hours) - min(hours) + 1
    assert filled.filter("energy_consumption is not null").count() == len(hours)


def test_repeated_hour_fails(make_panel):
    with pytest.raises(Exception, match="more than one row"):
        joins.fill_hours(make_panel({(0, 111): [(0, 1.0), (0, 2.0)]})).collect()


def test_grid_has_unseen_pairs(make_panel, hour):
    panel = make_panel({(0, 111): [(0, 1.0)], (0, 112): [(0, 1.0)], (1, 111): [(4, 1.0)]})
    grid = joins.horizon_grid(panel, 3).collect()
    assert len(grid) == 4 * 3 and {r["datetime_utc"] for r in grid} == {hour(5), hour(6), hour(7)}
    assert any((r["area"], r["consumer_type"]) == (1, 112) for r in grid)
    plan = joins.key_product(panel)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("cached, new, kept", [(5.0, 6.0, 5.0), (None, 6.0, 6.0), (5.0, None, 5.0)])
def test_overlay(make_panel, cached, new, kept):
    old, fresh = make_panel({(0, 111): [(0, cached)]}), make_panel({(0, 111): [(0, new)]})
    assert joins.overlay(joins.merge_versions(fresh, old)).first()["energy_consumption"] == kept


def test_misaligned(make_panel, hour):
    left, right = make_panel({(0, 111): [(0, 1.0), (1, 1.0)]}), make_panel({(0, 111): [(1, 1.0), (2, 1.0)]})
    got = {(r["datetime_utc"], r["only_in"]) for r in joins.misaligned(left, right).collect()}
    assert got == {(hour(0), "left"), (hour(2), "right")}
    assert joins.misaligned(left, left).isEmpty()


def pairs(spark, *rows):
    return spark.createDataFrame(rows, "area tinyint, consumer_type int, y double, p double")


def test_metrics(spark):
    row = aggregates.score(pairs(spark, (0, 111, 10.0, 9.0), (0, 111, 20.0, 22.0))).first()
    assert row["MAPE"] == pytest.approx(0.1) and row["RMSPE"] == pytest.approx(0.1)
    assert aggregates.score(pairs(spark, (0, 111, 0.0, 1.0))).first()["MAPE"] == 1 / EPSILON


def test_slices_and_overall(spark):
    rows = [(0, 111, 10.0, 9.0), (0, 111, 10.0, 8.0), (1, 111, 10.0, 4.0)]
    got = {r["area"]: r for r in aggregates.score_slices(pairs(spark, *rows)).collect()}
    assert got[0]["MAPE"] == pytest.approx(0.15) and got[1]["MAPE"] == pytest.approx(0.6)
    assert got[None]["overall"] and got[None]["MAPE"] == pytest.approx(statistics.mean([0.1, 0.2, 0.6]))


def test_best_config_breaks_ties(spark):
    means = spark.createDataFrame([(2, 0.1), (1, 0.1), (0, 0.2)], "config_id int, MAPE double")
    assert aggregates.best_config(means).first()["config_id"] == 1


def test_pages_are_bounded_and_whole(make_panel):
    panel = make_panel({(0, 111): [(h, float(h)) for h in range(25)]})
    got = sorted(aggregates.pages(panel, page_hours=10).collect(), key=lambda r: r["page"])
    assert [len(r["datetime_utc"]) for r in got] == [8, 10, 7] and [r["page"] for r in got] == [47335, 47336, 47337]
    assert [v for r in got for v in r["energy_consumption"]] == [float(h) for h in range(25)]


def test_pages_keep_their_numbers_when_old_hours_leave(make_panel):
    panel = make_panel({(0, 111): [(h, float(h)) for h in range(100)], (1, 111): [(h, 1.0) for h in range(5, 40)]})
    pages = lambda df: {(r["area"], r["page"]): r["datetime_utc"] for r in aggregates.pages(df, page_hours=10).collect()}
    whole, later = pages(panel), pages(panel.filter("datetime_utc >= '2024-01-02 06:00:00'"))
    assert later == {k: [t for t in v if t >= 473352 + 30] for k, v in whole.items() if v[-1] >= 473352 + 30}
    index = aggregates.page_index(aggregates.pages(panel, page_hours=10)).orderBy("area", "page").collect()
    assert [(r["rows"], r["offset"]) for r in index if r["area"] == 1] == [(3, 0), (10, 3), (10, 13), (10, 23), (2, 33)]


@pytest.mark.parametrize("count", [1001, 5000, 5001, 9999])
def test_newest_of_any_size_without_sorting_a_series(make_panel, count):
    panel = make_panel({(0, 111): [(h, float(h)) for h in range(6000)], (1, 111): [(3 * h, 1.0) for h in range(1500)], (2, 111): [(7, 1.0)]})
    kept = ts.newest(panel, count)
    assert kept.columns == panel.columns
    got = {(r["area"], r["n"]): r["lo"] for r in kept.groupBy("area").agg(F.count("*").alias("n"), F.min("energy_consumption").alias("lo")).collect()}
    assert got == {(0, min(count, 6000)): float(max(0, 6000 - count)), (1, min(count, 1500)): 1.0, (2, 1): 1.0}
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "row_number" in line]
    assert windows and all("_bucket" in line for line in windows)


def test_products_of_several_keys(spark):
    df = spark.createDataFrame([(a, b, c) for a, b, c in ((1, "x", 5), (2, "y", 5), (3, "z", 6), (4, None, 6))], "a int, b string, c int")
    assert joins.key_product(df, "a", "b", "c").count() == 4 * 4 * 2 and joins.key_product(df, "a").count() == 4
    assert joins.key_product(df.limit(0), "a", "b").count() == 0
    parts = lambda d: joins.key_product(d, "a", "b")._jdf.queryExecution().optimizedPlan().toString()
    assert f"{spark.sparkContext.defaultParallelism * joins.PARTS_PER_CORE}" in parts(df)


def test_series_by_split(make_panel):
    train, test = make_panel({(0, 111): [(1, 2.0), (0, 1.0)]}), make_panel({(0, 111): [(2, 3.0)]})
    labelled = aggregates.label_splits({"y_train": train, "y_test": test})
    row = aggregates.series_by_split(labelled, ("y_train", "y_test")).first()
    assert row["y_train"] == [1.0, 2.0] and row["y_test"] == [3.0]


def test_fill_hours_flags_observations_and_refuses_other_times(spark, make_panel, hour):
    panel = make_panel({(0, 111): [(3, 0.0), (50, -2.0)], (1, 112): [(5, 1.0)]})
    filled = joins.fill_hours(panel, fill=0.0, span="table", observed="observed")
    assert filled.count() == 96
    seen = {(r.area, r.datetime_utc): r.energy_consumption for r in filled.where("observed").collect()}
    assert seen == {(0, hour(3)): 0.0, (0, hour(50)): -2.0, (1, hour(5)): 1.0}
    late = panel.withColumn("datetime_utc", F.timestamp_add("MINUTE", F.lit(30), "datetime_utc"))
    with pytest.raises(Exception, match="not on a full hour"):
        joins.fill_hours(late).collect()
    assert joins.fill_hours(panel.limit(0), span="table").count() == 0


def test_gap_filling_reads_its_input_once(make_panel):
    panel = make_panel({(0, 111): [(3, 0.0), (50, -2.0)]})
    plan = joins.fill_hours(panel)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Scan ExistingRDD") <= 2  # initial and final plan of one scan


def test_a_long_series_is_dealt_by_bucket_after_a_split(make_panel):
    """Also where the rows are together by series already."""
    panel = make_panel({(0, 111): [(h, 1.0) for h in range(100)]})
    train = split(panel)[0].repartition("area", "consumer_type")
    plan = ts.history(train, length=3)._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert any("_bucket" in line for line in exchanges)
