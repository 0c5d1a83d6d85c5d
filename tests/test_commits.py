import threading

import pytest
from pyspark.sql import functions as F

from panelcast.operators import statistics
from panelcast.plans import prediction, training
from panelcast.schemas import FORECAST
from panelcast.sources import commits, feature_table, results, table_statistics
from panelcast.sources.commits import Commit, Conflict, claim, commit, head, put_if_absent, retain, sweep


def values(df):
    return sorted((str(r["datetime_utc"]), r["area"], r["energy_consumption"]) for r in df.collect())


class Stopped(Exception):
    pass


@pytest.fixture
def stopping(monkeypatch):
    """Every commit fails, as if the driver stopped after the data was written."""
    def stop(*_):
        raise Stopped
    def set_up(*modules):
        for m in modules:
            monkeypatch.setattr(m, "commit", stop)
    return set_up


def test_a_name_is_taken_once(spark, tmp_path):
    path = str(tmp_path / "log" / "1.json")
    won = []
    threads = [threading.Thread(target=lambda k=k: won.append((put_if_absent(spark, path, f"{k}" * 1000), k))) for k in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    (winner,) = [k for ok, k in won if ok]
    assert open(path).read() == f"{winner}" * 1000 and [p.name for p in (tmp_path / "log").iterdir() if not p.name.startswith(".")] == ["1.json"]


def test_commits_of_other_parts_are_kept_and_of_the_same_part_refused(spark, tmp_path):
    root = str(tmp_path)
    base = commit(spark, root, Commit(), {"a": {"1": ["x"]}, "b": {"1": ["y"]}})
    commit(spark, root, base, {"a": {"1": ["x2"]}})
    assert commit(spark, root, base, {"b": {"2": ["z"]}}).parts == {"a": {"1": ["x2"]}, "b": {"1": ["y"], "2": ["z"]}}
    with pytest.raises(Conflict):
        commit(spark, root, base, {"a": {"1": ["x3"]}})
    assert head(spark, root).number == 3 and commit(spark, root, head(spark, root), {"a": {"1": None}}).parts == {"b": {"1": ["y"], "2": ["z"]}}


def test_versions_are_claimed_apart(spark, tmp_path):
    root, got = str(tmp_path), []
    threads = [threading.Thread(target=lambda k=k: got.append((claim(spark, root, "m", lambda v: [f"f{k}"]), k))) for k in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(v for v, _ in got) == [1, 2, 3, 4, 5, 6] and head(spark, root).of("m") == {str(v): [f"f{k}"] for v, k in got}
    assert retain(spark, root, 2) == {"m": [1, 2, 3, 4]} and set(head(spark, root).of("m")) == {"5", "6"}


def test_upsert_that_stops_changes_nothing_and_a_second_writer_is_refused(spark, make_panel, tmp_path, stopping, monkeypatch):
    path = str(tmp_path / "table")
    feature_table.upsert(spark, path, make_panel({(0, 111): [(h, 1.0) for h in range(48)]}))
    opened, before = feature_table.read_table(spark, path), values(feature_table.read_table(spark, path))
    batch = make_panel({(0, 111): [(3, 9.0)], (1, 111): [(3, 9.0)]})
    with monkeypatch.context() as patch:
        patch.setattr(feature_table, "commit", lambda *_: (_ for _ in ()).throw(Stopped()))
        with pytest.raises(Stopped):
            feature_table.upsert(spark, path, batch)
    assert values(feature_table.read_table(spark, path)) == before
    real = feature_table.commit

    def late(*args):  # another writer commits the same day in between
        monkeypatch.setattr(feature_table, "commit", real)
        feature_table.upsert(spark, path, make_panel({(0, 111): [(4, 7.0)]}))
        return real(*args)

    monkeypatch.setattr(feature_table, "commit", late)
    with pytest.raises(Conflict):
        feature_table.upsert(spark, path, batch)
    feature_table.upsert(spark, path, batch)
    assert values(opened) == before  # a reader keeps the state it opened
    got = feature_table.read_table(spark, path)
    assert got.count() == 49 and got.where("energy_consumption = 9").count() == 2 and got.where("energy_consumption = 7").count() == 1


def test_layers_are_merged_by_readers_and_by_compaction(spark, make_panel, tmp_path):
    path, copy = str(tmp_path / "layered"), str(tmp_path / "merged")
    batches = [{(0, 111): [(h, 1.0) for h in range(72)]}, {(0, 111): [(30, 5.0)], (1, 111): [(80, 2.0)]}, {(0, 111): [(30, 6.0), (2, 3.0)]}]
    for b in batches:
        feature_table.upsert(spark, path, make_panel(b), merge=False)
        feature_table.upsert(spark, copy, make_panel(b))
    want = values(feature_table.read_table(spark, copy))
    assert values(feature_table.read_table(spark, path)) == want
    assert {d: len(f) for d, f in head(spark, path).of("rows").items()} == {"2024-01-01": 2, "2024-01-02": 3, "2024-01-03": 1, "2024-01-04": 1}
    assert feature_table.compact(spark, path) == ["2024-01-01", "2024-01-02"] and feature_table.compact(spark, path) == []
    assert values(feature_table.read_table(spark, path)) == want
    removed = sweep(spark, path, older_than=0)
    assert len(removed) >= 3 and values(feature_table.read_table(spark, path)) == want and sweep(spark, path, older_than=0) == []


def test_a_day_is_written_once(spark, make_panel, tmp_path):
    path = str(tmp_path / "table")
    feature_table.upsert(spark, path, make_panel({(0, 111): [(h, 1.0) for h in range(72)]}))
    feature_table.upsert(spark, path, make_panel({(0, 111): [(30, 2.0)]}))
    days = sorted(p.name for p in (tmp_path / "table" / "data").glob("*/day=*"))
    assert days == ["day=2024-01-01", "day=2024-01-02", "day=2024-01-02", "day=2024-01-03"]


def test_publish_is_all_or_nothing(spark, make_panel, tmp_path, monkeypatch):
    root = str(tmp_path)
    old, new = (make_panel({(0, 111): [(0, v)]}).select(*FORECAST.names) for v in (1.0, 2.0))
    results.publish({"X": old, "y": old}, root)
    with monkeypatch.context() as patch:
        patch.setattr(results, "commit", lambda *_: (_ for _ in ()).throw(Stopped()))
        with pytest.raises(Stopped):
            results.publish({"X": new, "y": new}, root)
    read = lambda n: values(results.read_published(spark, root, n, FORECAST))
    assert read("X") == read("y") == values(old)
    results.publish({"X": new}, root)
    assert read("X") == values(new) and read("y") == values(old)


def test_the_cache_touches_only_the_days_of_the_forecast(spark, make_panel, tmp_path, hour, monkeypatch):
    root = str(tmp_path)
    series = lambda hours, v: make_panel({(0, 111): [(h, v) for h in hours]}).select(*FORECAST.names)
    results.publish({"predictions_monitoring": series(range(96), 1.0)}, root)
    first = prediction.update_cache(spark, series(range(90, 120), 2.0), root, hour(30))
    assert values(first) == values(series(range(30, 96), 1.0).union(series(range(96, 120), 2.0)))
    log = f"{root}/published"
    before = head(spark, log).of("predictions_monitoring")
    assert set(before) == {f"2024-01-0{d}" for d in range(2, 6)}
    with monkeypatch.context() as patch:
        patch.setattr(results, "commit", lambda *_: (_ for _ in ()).throw(Stopped()))
        with pytest.raises(Stopped):
            prediction.update_cache(spark, series(range(118, 144), 3.0), root, hour(60))
    assert values(results.read_published(spark, root, "predictions_monitoring", FORECAST)) == values(first)
    second = prediction.update_cache(spark, series(range(118, 144), 3.0), root, hour(60))
    assert values(second) == values(series(range(60, 96), 1.0).union(series(range(96, 120), 2.0)).union(series(range(120, 144), 3.0)))
    after = head(spark, log).of("predictions_monitoring")
    assert after["2024-01-04"] == before["2024-01-04"] and "2024-01-02" not in after


def test_configurations_stay_in_the_log(spark, tmp_path):
    root = str(tmp_path)
    for k in (1, 2):
        training.publish_best(spark.range(1).select(F.lit(k).alias("config_id")), root)
    assert training.read_best(spark, root, "config_id int").first()[0] == 2
    assert len(head(spark, f"{root}/configs").of("best_config")) == 2 and commits.retain(spark, f"{root}/configs", 1) == {"best_config": [1]}


def test_statistics_follow_the_days_that_change(spark, make_panel, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    feature_table.upsert(spark, path, make_panel({(a, 111): [(h, float(h * (a + 1))) for h in range(96)] for a in range(3)}))
    columns = ("area", "energy_consumption")
    assert table_statistics.refresh(spark, path, columns) == [f"2024-01-0{d}" for d in range(1, 5)] and table_statistics.refresh(spark, path, columns) == []
    feature_table.upsert(spark, path, make_panel({(0, 111): [(30, 1000.0)]}))
    assert table_statistics.refresh(spark, path, columns) == ["2024-01-02"]
    rows = feature_table.read_table(spark, path)
    got = {r["column"]: r for r in statistics.summarised(table_statistics.table_states(spark, path)).collect()}
    want = {r["column"]: r for r in statistics.describe_columns(rows, columns, exact_distinct=True).collect()}
    for c in columns:
        assert [got[c][m] for m in ("count", "nulls", "min", "max")] == [want[c][m] for m in ("count", "nulls", "min", "max")]
        assert got[c]["mean"] == pytest.approx(want[c]["mean"]) and got[c]["std"] == pytest.approx(want[c]["std"])
        assert got[c]["distinct"] == pytest.approx(want[c]["distinct"], rel=0.05)
    corr = table_statistics.table_correlations(spark, path).first()["corr"]
    assert corr == pytest.approx(statistics.correlations(rows, columns).first()["corr"])
    bins = statistics.estimated_histogram(table_statistics.table_states(spark, path), 4).where("column = 'energy_consumption'").collect()
    assert len(bins) == 4 and bins[0]["lo"] == 0.0 and bins[3]["hi"] == 1000.0 and sum(r["rows"] for r in bins) == 288
    for r in bins:
        inside = rows.where(f"energy_consumption >= {r['lo']} and energy_consumption < {r['hi']}").count()
        assert abs(inside - r["rows"]) <= 0.02 * 288 + 3
