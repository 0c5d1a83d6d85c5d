from datetime import datetime

import pytest
from pyspark.sql import functions as F

from panelcast.functions.hours import epoch_hour, from_epoch_hour, parse_logical_date
from panelcast.operators import windows
from panelcast.plans.ingest import in_window


def bounds(spark, reference, **options):
    refs = spark.createDataFrame([(reference,)], "reference timestamp_ntz")
    row = windows.export_windows(refs, **options).first()
    return row["window_start"], row["window_end"]


def test_half_open_range(make_panel, hour):
    panel = make_panel({(0, 111): [(0, 1.0), (1, 2.0), (2, 3.0)]})
    kept = windows.between_hours(panel, hour(0), hour(2)).collect()
    assert sorted(r["datetime_utc"] for r in kept) == [hour(0), hour(1)]
    assert windows.between_hours(panel, hour(0), hour(2), closed="both").count() == 3
    with pytest.raises(ValueError):
        windows.between_hours(panel, hour(0), hour(2), closed="right")


@pytest.mark.parametrize("reference, start, end", [
    (datetime(2030, 1, 1), datetime(2023, 5, 31, 21), datetime(2023, 6, 30, 21)),
    (datetime(2020, 7, 20), datetime(2020, 6, 30, 22), datetime(2020, 7, 30, 22)),
    (datetime(2022, 5, 1, 10, 59, 30, 500000), datetime(2022, 3, 17, 10), datetime(2022, 4, 16, 10)),
])
def test_export_window_clamps(spark, reference, start, end):
    assert bounds(spark, reference) == (start, end)
    assert windows.export_window(reference) == (start, end)


def test_default_window_ends_with_the_dataset():
    assert windows.export_window()[1] == datetime(2023, 6, 30, 21)


def test_logical_dates_drop_fraction_and_offset(spark):
    texts = ["2023-04-14 05:00:00.123456+00:00", "2023-04-14 05:00:00+02:00"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(parse_logical_date("t").alias("d"))
    assert {r["d"] for r in df.collect()} == {datetime(2023, 4, 14, 5)}


def test_logical_date_in_another_form_fails(spark):
    df = spark.createDataFrame([("14/04/2023 05:00",)], "t string").select(parse_logical_date("t").alias("d"))
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP"):
        df.collect()


def test_epoch_hours(spark):
    row = spark.range(1).select(from_epoch_hour(F.lit(473352)).alias("t")).select("t", epoch_hour("t").alias("h")).first()
    assert row["t"] == datetime(2024, 1, 1) and row["h"] == 473352


def test_short_window_is_incomplete(make_panel):
    panel = make_panel({(0, 111): [(h, 1.0) for h in range(719)]})
    row = windows.completeness(panel).first()
    assert (row["expected"], row["actual"], row["ok"]) == (720, 719, False)
    with pytest.raises(RuntimeError, match="719"):
        windows.require_complete(panel)


def test_backfill_equals_one_filter_per_window(make_panel, hour):
    panel = make_panel({(a, 111): [(h, float(h)) for h in range(200)] for a in (0, 1)})
    refs = windows.daily_references(panel, 4)
    wins = windows.export_windows(refs, days_delay=1, days_export=2, dataset_start=hour(0), dataset_end=hour(199))
    wins = wins.select("window_start", "window_end")
    got = windows.backfill(panel, wins).groupBy("window_start").count().collect()
    want = {
        w["window_start"]: windows.between_hours(panel, w["window_start"], w["window_end"]).count()
        for w in wins.collect()
    }
    assert {r["window_start"]: r["count"] for r in got} == want
    coverage = windows.backfill_coverage(panel, wins).collect()
    assert {r["window_start"]: r["rows"] for r in coverage} == want
    assert all(r["hours"] == 48 for r in coverage)


def test_text_window(spark):
    raw = spark.createDataFrame([("2024-01-01 00:00",), ("2024-01-01 01:00",), ("2024-01-01 02:00",)], "HourUTC string")
    assert in_window(raw, datetime(2024, 1, 1), datetime(2024, 1, 1, 2)).count() == 2
