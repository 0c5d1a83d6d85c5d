import pytest

from panelcast.operators.features import WindowFeatures
from panelcast.operators.timeseries import calendar
from panelcast.session import scratch_path
from panelcast.sources import commits, feature_store, feature_table
from panelcast.sources.feature_store import Features

SMALL = Features(lags=(1, 24, 30), means=((1, 24),), stds=((2, 5),))


def values(df):
    return sorted((r.datetime_utc, r.area, r.consumer_type, r.energy_consumption, tuple(r.window), r.day_of_week) for r in df.collect())


def whole(spark, table, features=SMALL):
    rows = feature_table.read_table(spark, table)
    return values(calendar(WindowFeatures(lags=features.lags, means=features.means, stds=features.stds).transform(rows)))


@pytest.fixture
def table(spark, make_panel):
    path = scratch_path(spark, "features-test")
    series = {(0, 111): [(h, float(h * 7 % 13)) for h in range(240)], (1, 111): [(h, float(h % 11)) for h in range(240) if h != 100]}
    feature_table.upsert(spark, path, make_panel(series))
    assert len(feature_store.refresh(spark, path, SMALL)) == 10
    return path


def test_stored_features_equal_a_full_run(spark, table):
    got = values(feature_store.read_features(spark, table, SMALL))
    assert got == whole(spark, table) and len(got) == 240 - 30 + 240 - 30 - 31
    assert feature_store.refresh(spark, table, SMALL) == []


def test_a_late_day_remakes_itself_and_the_days_its_hours_reach(spark, table, make_panel):
    folders = lambda: commits.head(spark, feature_store.store_path(table)).of("folders")
    before = folders()
    feature_table.upsert(spark, table, make_panel({(0, 111): [(75, 99.0)], (1, 111): [(100, 5.0)]}), merge=False)
    late = ["2024-01-04", "2024-01-05", "2024-01-06", "2024-01-07"]
    assert feature_store.stale(spark, table, SMALL) == late
    with pytest.raises(RuntimeError, match="refresh"):
        feature_store.read_features(spark, table, SMALL)
    assert feature_store.read_features(spark, table, SMALL, last="2024-01-03").count() == 2 * (72 - 30)
    assert feature_store.refresh(spark, table, SMALL) == late
    assert {d for d, f in folders().items() if before.get(d) != f} == set(late)
    assert values(feature_store.read_features(spark, table, SMALL)) == whole(spark, table)


def test_new_and_distant_days(spark, table, make_panel):
    feature_table.upsert(spark, table, make_panel({(0, 111): [(h, 1.0) for h in [*range(240, 264), *range(960, 1008)]], (2, 112): [(3, 1.0)]}))
    assert feature_store.refresh(spark, table, SMALL) == [
        "2024-01-01", "2024-01-02", "2024-01-03", "2024-01-11", "2024-02-10", "2024-02-11"]
    assert values(feature_store.read_features(spark, table, SMALL)) == whole(spark, table)


def test_a_stop_before_the_commit_changes_nothing(spark, table, make_panel, monkeypatch):
    feature_table.upsert(spark, table, make_panel({(0, 111): [(239, 50.0)]}))
    log, number = feature_store.store_path(table), commits.head(spark, feature_store.store_path(table)).number

    def stop(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(feature_store, "commit", stop)
        with pytest.raises(KeyboardInterrupt):
            feature_store.refresh(spark, table, SMALL)
    assert commits.head(spark, log).number == number
    assert feature_store.refresh(spark, table, SMALL) == ["2024-01-10"]
    assert values(feature_store.read_features(spark, table, SMALL)) == whole(spark, table)


def test_another_definition_and_compaction_remake_days(spark, table, make_panel):
    other = Features(lags=(1, 24, 30), means=(), stds=())
    assert len(feature_store.stale(spark, table, other)) == 10
    feature_table.upsert(spark, table, make_panel({(0, 111): [(230, 50.0)]}), merge=False)
    feature_store.refresh(spark, table, SMALL)
    feature_table.compact(spark, table)
    assert feature_store.refresh(spark, table, SMALL) == ["2024-01-10"]


def test_gaps_stay_null_and_removed_days_go(spark, make_panel):
    path, features = scratch_path(spark, "gaps"), Features(lags=(1, 24), means=((1, 3),), stds=(), with_calendar=False, full=False)
    feature_table.upsert(spark, path, make_panel({(0, 111): [(0, 1.0), (1, 2.0), (2, 3.0), (3, 4.0), (5, 6.0), (26, 7.0)]}))
    feature_store.refresh(spark, path, features)
    got = {r.datetime_utc.day * 24 + r.datetime_utc.hour - 24: (r.lag_1, r.lag_24, r.mean_1_3) for r in feature_store.read_features(spark, path, features).collect()}
    assert got == {0: (None, None, None), 1: (1.0, None, None), 2: (2.0, None, None), 3: (3.0, None, 2.0), 5: (None, None, None), 26: (None, 3.0, None)}
    commits.commit(spark, path, commits.head(spark, path), {"rows": {"2024-01-01": None}})
    assert feature_store.refresh(spark, path, features) == ["2024-01-02"]
    assert [(r.lag_24,) for r in feature_store.read_features(spark, path, features).collect()] == [(None,)]


def test_an_empty_table_has_no_features(spark, make_panel):
    path = scratch_path(spark, "nothing")
    feature_table.upsert(spark, path, make_panel({}))
    assert feature_store.refresh(spark, path, SMALL) == [] and feature_store.read_features(spark, path, SMALL).columns[-1] == "hour_of_day"
