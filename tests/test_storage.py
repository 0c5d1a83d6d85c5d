import os

import pytest
from pyspark.sql import functions as F

from panelcast.operators.windows import export_metadata
from panelcast.plans.ingest import FEATURE_RUN, run_ingest, run_view
from panelcast.plans.prediction import last_ingested
from panelcast.schemas import FORECAST, PANEL, RAW
from panelcast.session import scratch_path
from panelcast.sources import commits, feature_table, landed, paths, results, snapshots


def rows(df):
    return sorted(tuple(r) for r in df.select(*PANEL.names).collect())


def test_empty_and_malformed_files(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    with pytest.raises(ValueError, match="no records"):
        landed.require_rows(landed.read_delimited(spark, str(tmp_path / "empty.csv")), "empty.csv")
    (tmp_path / "bad.csv").write_text("HourUTC;HourDK;PriceArea;ConsumerType_DE35;TotalCon\na;b;DK;x;1\n")
    with pytest.raises(Exception, match="MALFORMED|BAD_RECORD|FAILED_READ"):
        landed.read_delimited(spark, str(tmp_path / "bad.csv")).collect()
    (tmp_path / "bad.json").write_text('{"records": [')
    with pytest.raises(Exception, match="MALFORMED|BAD_RECORD|FAILED_READ"):
        landed.read_payloads(spark, str(tmp_path / "bad.json")).collect()


def test_payload_over_several_lines(spark, tmp_path):
    (tmp_path / "page.json").write_text(
        '{"total": 1,\n "records": [{"HourUTC": "2024-01-01 00:00", "PriceArea": "DK",\n'
        ' "ConsumerType_DE35": 111, "TotalCon": 1.5}]}'
    )
    got = landed.read_payloads(spark, str(tmp_path / "page.json"), multi_line=True)
    assert got.columns == RAW.names and got.first()["TotalCon"] == 1.5


def test_absent_dataset_is_an_empty_table(spark):
    got = landed.read_or_empty(spark, scratch_path(spark, "absent"), FORECAST)
    assert got.schema == FORECAST and got.isEmpty()


def test_upsert_replaces_inserts_and_is_idempotent(spark, make_panel):
    path = scratch_path(spark, "table")
    stored = make_panel({(0, 111): [(h, 1.0) for h in range(72)]})
    batch = make_panel({(0, 111): [(30, 5.0), (31, 6.0)], (1, 111): [(30, 7.0)]})
    feature_table.upsert(spark, path, stored)
    untouched = commits.head(spark, path).of("rows")["2024-01-01"]
    feature_table.upsert(spark, path, batch)
    once = rows(feature_table.read_table(spark, path))
    feature_table.upsert(spark, path, batch)
    assert rows(feature_table.read_table(spark, path)) == once
    assert len(once) == 73 and sum(r[3] for r in once) == 70 + 5 + 6 + 7
    assert commits.head(spark, path).of("rows")["2024-01-01"] == untouched


def test_range_read_prunes_days(spark, make_panel, hour):
    path = scratch_path(spark, "table")
    feature_table.upsert(spark, path, make_panel({(0, 111): [(h, 1.0) for h in range(96)]}))
    part = feature_table.read_range(spark, path, hour(25), hour(47))
    assert part.count() == 22
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(datetime_utc)" in plan
    assert {f.rsplit("day=", 1)[1][:10] for f in part.inputFiles()} == {"2024-01-02"}


def test_column_descriptions_survive_the_schema(spark, make_panel):
    described = feature_table.describe(make_panel({(0, 111): [(0, 1.0)]}))
    got = {r["name"]: r for r in feature_table.descriptions(described).collect()}
    assert "kWh" in got["energy_consumption"]["description"] and got["area"]["non_null"] == 1


def test_view_versions_and_snapshot(spark, make_panel, hour):
    root, path = scratch_path(spark, "views"), scratch_path(spark, "table")
    feature_table.upsert(spark, path, make_panel({(0, 111): [(h, float(h)) for h in range(48)]}))
    assert [feature_table.create_view(spark, root, "use", path) for _ in range(2)] == [1, 2]
    assert spark.sql("select * from use_v2").count() == 48
    with pytest.raises(LookupError):
        feature_table.open_view(spark, root, "use", 3)
    view = feature_table.open_view(spark, root, "use", 1)
    snapshots.write_snapshot(view, root, hour(0), hour(24))
    stored = snapshots.read_snapshot(spark, root)
    assert stored.schema == PANEL and stored.count() == 24


def test_old_versions_are_dropped(spark, make_panel):
    root = scratch_path(spark, "versions")
    for v in (1, 2, 10):
        make_panel({(0, 111): [(0, float(v))]}).write.parquet(feature_table.table_path(root, v))
    assert feature_table.drop_old_versions(spark, root, keep=2) == [1]
    assert paths.versions(spark, root) == [2, 10]


def test_hours_are_published_as_integers(spark, make_panel):
    root = scratch_path(spark, "results")
    df = make_panel({(0, 111): [(0, 1.0)]}).select(*FORECAST.names)
    where = results.publish({"predictions": df}, root)["predictions"]
    assert spark.read.parquet(where).first()["datetime_utc"] == 473352
    assert results.read_published(spark, root, "predictions", FORECAST).collect() == df.collect()
    assert results.read_published(spark, root, "never", FORECAST).isEmpty()


def test_run_records(spark, make_panel, hour):
    root = scratch_path(spark, "runs")
    with pytest.raises(FileNotFoundError):
        results.latest_run(spark, root, "feature", FEATURE_RUN)
    panel = make_panel({(0, 111): [(0, 1.0), (1, 1.0)]})
    for version in (1, 2):
        run = export_metadata(panel, hour(0), hour(2), "here").withColumn("feature_group_version", F.lit(version))
        results.record_run(run, root, "feature")
    last = results.latest_run(spark, root, "feature", FEATURE_RUN).first()
    assert last["feature_group_version"] == 2 and last["num_unique_samples_per_time_series"] == 2
    assert last["export_datetime_utc_end"] == "2024-01-01 02:00"


def raw_rows(spark, hours, hour, value=1.0):
    rows = [(hour(h).strftime("%Y-%m-%d %H:%M"), "-", area, 111, value) for h in hours for area in ("DK", "DK1")]
    return spark.createDataFrame(rows, RAW)


def test_ingest_job(spark, hour):
    root = scratch_path(spark, "ingest")
    raw = raw_rows(spark, range(24 * 6), hour)
    options = {"days_delay": 1, "days_export": 2, "dataset_start": hour(0), "dataset_end": hour(24 * 6)}
    run = run_ingest(spark, raw, root, hour(24 * 4), **options).first()
    assert run["export_datetime_utc_start"] == "2024-01-02 00:00" and run["num_unique_samples_per_time_series"] == 48
    start, end = last_ingested(spark, root)
    assert [f"{t:%Y-%m-%d %H:%M}" for t in (start, end)] == [run["export_datetime_utc_start"][:16], run["export_datetime_utc_end"][:16]]
    assert spark.read.parquet(f"{root}/statistics").first()["count"] > 0 and spark.read.parquet(f"{root}/validation").where("not ok").count() == 0
    run_ingest(spark, raw, root, hour(24 * 5), **options)
    table = feature_table.read_table(spark, feature_table.table_path(root, 1))
    assert table.count() == 2 * 72
    view = run_view(spark, root, hour(24), hour(48)).first()
    assert (view["feature_view_version"], view["training_dataset_version"]) == (1, 1)
    with pytest.raises(RuntimeError, match="distinct hours"):
        run_ingest(spark, raw_rows(spark, range(30), hour), root, hour(24 * 4), **options)
    with pytest.raises(ValueError, match="at_least"):
        run_ingest(spark, raw_rows(spark, range(24 * 6), hour, -1.0), root, hour(24 * 4), **options)


def test_the_row_that_landed_last_wins_even_if_it_lowers_a_value(spark, make_panel, tmp_path):
    path = str(tmp_path / "table")
    batch = make_panel({(0, 111): [(0, 9.0), (1, 5.0)]}).withColumn("landed", F.lit(1))
    correction = make_panel({(0, 111): [(0, 4.0)]}).withColumn("landed", F.lit(2))
    for _ in range(2):
        feature_table.upsert(spark, path, batch.union(correction), order="landed")
        got = feature_table.read_table(spark, path).orderBy("datetime_utc").collect()
        assert [r.energy_consumption for r in got] == [4.0, 5.0]


def test_different_rows_for_one_key_without_an_order_fail(spark, make_panel, tmp_path):
    twice = make_panel({(0, 111): [(0, 9.0)]}).union(make_panel({(0, 111): [(0, 4.0)]}))
    with pytest.raises(Exception, match="different rows for one key"):
        feature_table.upsert(spark, str(tmp_path / "table"), twice)
    same = make_panel({(0, 111): [(0, 9.0)]})
    assert feature_table.latest_by_key(same.union(same)).count() == 1


def test_staged_copies_are_removed(spark, make_panel, tmp_path):
    folder = scratch_path(spark, "x").rsplit("/", 1)[0].removeprefix("file:")
    listed = lambda: set(os.listdir(folder)) if os.path.isdir(folder) else set()
    before, path = listed(), str(tmp_path / "table")
    for value in (1.0, 2.0):
        feature_table.upsert(spark, path, make_panel({(0, 111): [(0, value)]}))
    assert listed() == before


def test_retention_of_views_snapshots_and_models(spark, make_panel, tmp_path):
    root, table = str(tmp_path), str(tmp_path / "table")
    feature_table.upsert(spark, table, make_panel({(0, 111): [(0, 1.0)]}))
    for _ in range(3):
        feature_table.create_view(spark, root, "consumption", table)
    assert feature_table.drop_old_views(spark, root, keep=1) == 2
    assert [r.version for r in feature_table.manifest(spark, root).collect()] == [3]
    with pytest.raises(LookupError):
        feature_table.open_view(spark, root, "consumption", 1)
    for version in (1, 2, 3):
        snapshots.write_snapshot(feature_table.read_table(spark, table), root, "2024-01-01", "2024-01-02", version)
    assert feature_table.drop_old_versions(spark, root, keep=1, prefix="td_version") == [1, 2]
    assert snapshots.read_snapshot(spark, root, 3).count() == 1
