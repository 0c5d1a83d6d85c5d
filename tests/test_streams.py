from datetime import datetime

import pytest
from pyspark.sql import functions as F

from panelcast.functions.errors import mape
from panelcast.schemas import FORECAST, RAW
from panelcast.session import scratch_path
from panelcast.sources.commits import head
from panelcast.sources.feature_table import read_table
from panelcast.streaming import jobs


def drain(query):
    assert query.awaitTermination(120)
    assert query.exception() is None


def test_ingest_over_batches_and_a_restart(spark, hour):
    landing, table, state = (scratch_path(spark, n) for n in ("landing", "table", "state"))

    def land(hours, value):
        rows = [(hour(h).strftime("%Y-%m-%d %H:%M"), "-", "DK", 111, value) for h in hours]
        spark.createDataFrame(rows, RAW).coalesce(1).write.mode("append").parquet(landing)

    land(range(30), 1.0)
    drain(jobs.start_ingest(spark, landing, table, state, files_per_batch=1))
    land(range(20, 40), 2.0)
    drain(jobs.start_ingest(spark, landing, table, state, files_per_batch=1))
    got = read_table(spark, table)
    assert got.count() == 40
    assert got.filter("energy_consumption = 2").count() == 20


def test_bad_batch_stops_the_stream(spark):
    landing = scratch_path(spark, "landing")
    spark.createDataFrame([("2024-01-01 00:00", "-", "DK", 111, -1.0)], RAW).write.parquet(landing)
    query = jobs.start_ingest(spark, landing, scratch_path(spark, "t"), scratch_path(spark, "s"))
    with pytest.raises(Exception, match="expectations not met"):
        query.awaitTermination(120)


def test_scores_merge_over_batches(spark, make_panel):
    forecasts, truth, parts, state = (scratch_path(spark, n) for n in ("f", "t", "parts", "state"))
    p = make_panel({(a, 111): [(h, 10.0 + a) for h in range(6)] for a in range(3)}).select(*FORECAST.names)
    y = make_panel({(a, 111): [(h, 12.0 + h) for h in range(6)] for a in range(3)}).select(*FORECAST.names)
    p.write.parquet(forecasts)
    for area in range(3):
        y.filter(F.col("area") == area).coalesce(1).write.mode("append").parquet(truth)
    y.filter("area = 0").coalesce(1).write.mode("append").parquet(truth)  # a repeated delivery
    errors = jobs.matched_errors(
        jobs.landed_stream(spark, forecasts, FORECAST),
        jobs.landed_stream(spark, truth, FORECAST, files_per_batch=1),
    )
    drain(jobs.start_scoring(errors, parts, state))
    got = {r["datetime_utc"]: r["MAPE"] for r in jobs.read_scores(spark, parts).collect()}
    want = (
        y.withColumnRenamed("energy_consumption", "y")
        .join(p.withColumnRenamed("energy_consumption", "p"), ["area", "consumer_type", "datetime_utc"])
        .groupBy("datetime_utc").agg(mape("y", "p").alias("m")).collect()
    )
    assert got == {r["datetime_utc"]: pytest.approx(r["m"]) for r in want}


def test_closed_hours_come_once_and_folders_stay_few(spark, make_panel, tmp_path):
    forecasts, truth, root, state, late = (str(tmp_path / n) for n in ("f", "t", "scores", "state", "late"))
    series = lambda hours, v: make_panel({(a, 111): [(h, v + a) for h in hours] for a in range(2)}).select(*FORECAST.names)
    dropped = 0

    def run(hours, **more):
        nonlocal dropped
        series(hours, 10.0).coalesce(1).write.mode("append").parquet(forecasts)
        series(hours, 12.0).coalesce(1).write.mode("append").parquet(truth)
        scores = jobs.closed_scores(jobs.landed_stream(spark, forecasts, FORECAST), jobs.landed_stream(spark, truth, FORECAST), delay="2 hours")
        query = jobs.start_closed_scores(scores, root, state, most_folders=3, **more)
        drain(query)
        dropped += jobs.record_late_rows(spark, query, late)

    seen = []
    for start in range(0, 24, 4):
        run(range(start, start + 4))
        seen.append(jobs.read_closed_scores(spark, root).count())
        folders = head(spark, root).of("scores")
        assert all(len(f) <= 3 for f in folders.values())
    assert seen == sorted(seen) and seen[-1] == 23 - 2 and dropped == 0  # 21 hours end at or before the watermark, 21:00
    got = jobs.read_closed_scores(spark, root).orderBy("datetime_utc").collect()
    assert len({r["datetime_utc"] for r in got}) == 21 and {r["n"] for r in got} == {2}
    assert got[0]["MAPE"] == pytest.approx((2 / 12 + 2 / 13) / 2)
    run([2, 24])  # hour 2 is closed
    assert dropped > 0 and spark.read.parquet(late).agg(F.sum("rows")).first()[0] == dropped
    after = jobs.read_closed_scores(spark, root)
    assert after.count() == after.select("datetime_utc").distinct().count() == 22
    assert [r["n"] for r in after.where("datetime_utc = '2024-01-01 02:00:00'").collect()] == [2]


def test_a_replayed_batch_of_scores_is_skipped(spark, tmp_path):
    root = str(tmp_path / "scores")
    batch = spark.createDataFrame([(datetime(2024, 1, 1), 0.5, 3)], jobs.SCORES)
    written = []

    class Writer:
        def foreachBatch(self, write):
            written.append(write)
            return self

        def __getattr__(self, _):
            return lambda *a, **k: self

    class Stream:
        writeStream = Writer()

    jobs.start_closed_scores(Stream(), root, "unused")
    for batch_id in (0, 0, 1, 0, 1):
        written[0](batch, batch_id)
    assert jobs.read_closed_scores(spark, root).count() == 2
