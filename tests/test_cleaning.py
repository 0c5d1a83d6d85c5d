import pytest
from pyspark.sql import functions as F

from panelcast.operators import clean, quality
from panelcast.schemas import CONSUMER_TYPES, PANEL, RAW


def raw(spark, *rows):
    return spark.createDataFrame(rows, RAW)


def test_clean_contract(spark, hour):
    df = clean.clean(raw(spark, ("2024-01-01 05:00", "x", "DK2", 999, float("nan")), ("2024-01-01 06:00", "x", "DK", 111, 0.0)))
    assert df.schema.simpleString() == PANEL.simpleString()
    rows = {r["datetime_utc"]: r for r in df.collect()}
    assert rows[hour(5)]["area"] == 2 and rows[hour(5)]["energy_consumption"] is None
    assert rows[hour(6)]["area"] == 0


@pytest.mark.parametrize("area", ["DK9", None])
def test_unknown_area_fails(spark, area):
    with pytest.raises(Exception, match="no code for value"):
        clean.clean(raw(spark, ("2024-01-01 05:00", "x", area, 111, 1.0))).collect()


def test_bad_time_fails_or_is_rejected(spark):
    df = raw(spark, ("yesterday", "x", "DK", 111, 1.0), ("2024-01-01 05:00", "x", "DK", 111, 2.0))
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP"):
        clean.clean(df).collect()
    good, bad = clean.try_cast_types(df.transform(clean.drop_unused).transform(clean.rename))
    assert good.count() == 1 and bad.first()["datetime_utc"] == "yesterday"


def test_attach_keys_inverts(make_panel):
    panel = make_panel({(1, 111): [(0, 1.0)]})
    stage = clean.AttachKeys()
    wide = stage.transform(panel)
    assert wide.first()["area_exog"] == 1
    assert stage.inverse(wide).columns == panel.columns


def test_strip_suffix(spark):
    df = spark.range(1).select(F.lit(1).alias("k"), F.lit(2).alias("v_new"), F.lit(3).alias("v_cached"))
    assert clean.strip_suffix(df, "_new", ["k"]).columns == ["k", "v"]


def test_found(spark, make_panel):
    asked = spark.createDataFrame([(0, 111), (9, 111)], "area tinyint, consumer_type int")
    got = clean.found(asked, make_panel({(0, 111): [(0, 1.0)]})).collect()
    assert {r["area"]: r["found"] for r in got} == {0: True, 9: False}


def test_one_series_guard(make_panel):
    panel = make_panel({(0, 111): [(0, 1.0)]})
    assert clean.require_found(clean.one_series(panel, 0, 111), "0, 111").count() == 1
    with pytest.raises(LookupError, match="5, 111"):
        clean.require_found(clean.one_series(panel, 5, 111), "5, 111")


def failing(df):
    return {(r["check"], r["column"]) for r in quality.validate(df, quality.panel_suite(df)).collect() if not r["ok"]}


def test_valid_panel_passes(make_panel):
    assert failing(make_panel({(0, c): [(0, 0.0)] for c in CONSUMER_TYPES})) == set()


@pytest.mark.parametrize("change, broken", [
    ({"datetime_utc": "cast(null as timestamp_ntz)"}, {("not_null", "datetime_utc")}),
    ({"datetime_utc": "datetime_utc + interval 30 minutes"}, {("full_hours", "datetime_utc")}),
    ({"area": "cast(3 as tinyint)"}, {("in_set", "area")}),
    ({"area": "cast(area as int)"}, {("type_is_tinyint", "area")}),
    ({"consumer_type": "113"}, {("in_set", "consumer_type")}),
    ({"consumer_type": "cast(consumer_type as bigint)"}, {("type_is_int", "consumer_type")}),
    ({"energy_consumption": "-1D"}, {("at_least", "energy_consumption")}),
    ({"energy_consumption": "cast(null as double)"}, {("not_null", "energy_consumption")}),
    ({"energy_consumption": "cast(1 as float)"}, {("type_is_double", "energy_consumption")}),
])
def test_exactly_the_matching_check_fails(make_panel, change, broken):
    panel = make_panel({(0, 111): [(0, 1.0)]})
    for column, expression in change.items():
        panel = panel.withColumn(column, F.expr(expression))
    assert failing(panel) == broken


def test_column_rules(make_panel):
    panel = make_panel({(0, 111): [(0, 1.0)]})
    ordered = ("columns_match_ordered_list", ",".join(PANEL.names))
    assert failing(panel.select(*reversed(PANEL.names))) == {ordered}
    assert failing(panel.withColumn("extra", F.lit(1))) == {ordered, ("column_count", "*")}


def test_policies(spark, make_panel, tmp_path):
    panel = make_panel({(0, 111): [(0, 1.0), (1, -1.0)]})
    suite = quality.panel_suite(panel)
    rejected, report = str(tmp_path / "rejected"), str(tmp_path / "report")
    with pytest.raises(ValueError, match="at_least"):
        quality.enforce(panel, suite, report=report)
    assert quality.enforce(panel, suite, "warn", report=report).count() == 2
    good = quality.enforce(panel, suite, "quarantine", rejected, report)
    assert [r.energy_consumption for r in good.collect()] == [1.0]
    assert [r.energy_consumption for r in spark.read.parquet(rejected).collect()] == [-1.0]
    stored = spark.read.parquet(report).where("check = 'at_least'").collect()
    assert [(r.ok, r.bad_count, r.rows_checked) for r in stored] == [(False, 1, 2)] * 3
    for policy in ("warn", "quarantine"):  # nothing may go unrecorded
        with pytest.raises(ValueError, match="needs a table"):
            quality.enforce(panel, suite, policy)
    extra = panel.withColumn("more", panel.area)
    with pytest.raises(ValueError, match="column"):
        quality.enforce(extra, quality.panel_suite(extra), "quarantine", rejected)
    with pytest.raises(ValueError):
        quality.enforce(panel, suite, "other")
