"""J: expectations, each run on the clean panel and on a copy with defects."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from panelcast import fixtures
from panelcast.operators import quality as q
from panelcast.queries.registry import query
from panelcast.queries.sql import PANEL, ctes
from panelcast.schemas import AREA_CODES, CONSUMER_TYPES, PANEL as PANEL_SCHEMA

SPOILED = """spoiled as (
  select case when e < 1 then null when e < 2 then datetime_utc + interval 30 minute else datetime_utc end as datetime_utc,
         case when e >= 2 and e < 4 then cast(3 as tinyint) else area end as area,
         case when e >= 4 and e < 6 then 113 else consumer_type end as consumer_type,
         case when e >= 6 and e < 8 then -e when e >= 8 and e < 10 then null else e end as energy_consumption
  from (select *, energy_consumption as e from panel))"""


def spoiled(panel: DataFrame) -> DataFrame:
    """The panel with defects in rows of small values."""
    e = F.col("energy_consumption")
    half_past = F.col("datetime_utc") + F.expr("interval 30 minutes")
    return panel.select(
        F.when(e < 1, None).when(e < 2, half_past).otherwise(F.col("datetime_utc")).alias("datetime_utc"),
        F.when((e >= 2) & (e < 4), F.lit(3).cast("tinyint")).otherwise(F.col("area")).alias("area"),
        F.when((e >= 4) & (e < 6), F.lit(113)).otherwise(F.col("consumer_type")).alias("consumer_type"),
        F.when((e >= 6) & (e < 8), -e).when((e >= 8) & (e < 10), None).otherwise(e).alias("energy_consumption"),
    )


def misshapen(panel: DataFrame) -> DataFrame:
    """The panel with its columns in another order, one more, and other types."""
    return panel.select(
        F.col("area").cast("int").alias("area"), "datetime_utc", F.col("consumer_type").cast("bigint").alias("consumer_type"),
        F.col("energy_consumption").cast("float").alias("energy_consumption"), F.lit("x").alias("extra"),
    )


def report(spark, sf_dir, rules, shape: bool = False) -> DataFrame:
    panel = fixtures.panel(spark, sf_dir)
    tables = {"clean": panel, "spoiled": spoiled(panel), **({"misshapen": misshapen(panel)} if shape else {})}
    checked = [q.validate(df, rules(df)).withColumn("source", F.lit(n)) for n, df in tables.items()]
    return reduce(DataFrame.unionByName, checked)


def _row(check: str, column: str, bad: str) -> str:
    return "\nunion all ".join(
        f"""select '{check}' as "check", '{column}' as "column", {bad} = 0 as ok, {bad} as bad_count,
        count(*) as rows_checked, '{name}' as source from {table}"""
        for name, table in (("clean", "panel"), ("spoiled", "spoiled"))
    )


def _sql(*rows: str) -> str:
    return ctes(PANEL, SPOILED) + "\nunion all ".join(rows)


def _bad(condition: str) -> str:
    return f"count(*) filter (where {condition})"


PASS = "cast(0 as bigint)"
CODES = ", ".join(str(c) for c in CONSUMER_TYPES)
ROWS = {
    "j01": _row("columns_match_ordered_list", ",".join(PANEL_SCHEMA.names), PASS),
    "j02": _row("column_count", "*", PASS),
    "j03": _row("not_null", "datetime_utc", _bad("datetime_utc is null")),
    "j04": _row("in_set", "area", _bad("area not in (0, 1, 2)")),
    "j05": _row("type_is_tinyint", "area", PASS),
    "j06": _row("in_set", "consumer_type", _bad(f"consumer_type not in ({CODES})")),
    "j07": _row("type_is_int", "consumer_type", PASS),
    "j08": _row("at_least", "energy_consumption", _bad("energy_consumption < 0")),
    "j09": _row("type_is_double", "energy_consumption", PASS),
    "j10": _row("not_null", "energy_consumption", _bad("energy_consumption is null")),
    "j11": _row("full_hours", "datetime_utc", _bad("datetime_utc <> date_trunc('hour', datetime_utc)")),
}

RULES = {
    "j01_columns_match": lambda df: [q.columns_match(df, PANEL_SCHEMA.names)],
    "j02_column_count": lambda df: [q.column_count(df, 4)],
    "j03_time_not_null": lambda df: [q.not_null("datetime_utc")],
    "j04_area_in_set": lambda df: [q.in_set("area", AREA_CODES.values())],
    "j05_area_type": lambda df: [q.has_type(df, "area", "tinyint")],
    "j06_consumer_type_in_set": lambda df: [q.in_set("consumer_type", CONSUMER_TYPES)],
    "j07_consumer_type_type": lambda df: [q.has_type(df, "consumer_type", "int")],
    "j08_consumption_not_negative": lambda df: [q.at_least("energy_consumption", 0.0)],
    "j09_consumption_type": lambda df: [q.has_type(df, "energy_consumption", "double")],
    "j10_consumption_not_null": lambda df: [q.not_null("energy_consumption")],
    "j11_full_hours": lambda df: [q.full_hours("datetime_utc")],
}

SHAPE = ("j01", "j02", "j05", "j07", "j09")


def _shape_row(row: str) -> str:
    """The same check of a table that fails it."""
    check = row.split("'")
    return f"""
union all select '{check[1]}', '{check[3]}', false, 1, count(*), 'misshapen' from panel"""


for _name, _rules in RULES.items():
    _shape = _name[:3] in SHAPE
    query(_name, _sql(ROWS[_name[:3]]) + (_shape_row(ROWS[_name[:3]]) if _shape else ""))(
        lambda spark, sf_dir, rules=_rules, shape=_shape: report(spark, sf_dir, rules, shape))


@query("j12_suite", _sql(*ROWS.values()))
def j12(spark, sf_dir):
    return report(spark, sf_dir, q.panel_suite)


@query("j12b_quarantined_rows", ctes(PANEL, SPOILED) + f"""
select * from spoiled where datetime_utc is null or energy_consumption is null or area not in (0, 1, 2)
   or consumer_type not in ({CODES}) or energy_consumption < 0 or datetime_utc <> date_trunc('hour', datetime_utc)""")
def j12b(spark, sf_dir):
    table = spoiled(fixtures.panel(spark, sf_dir))
    return q.quarantine(table, q.panel_suite(table))[1]


@query("j12c_offending_values", ctes(PANEL, SPOILED) + f"""
select consumer_type, count(*) as rows from spoiled where consumer_type not in ({CODES}) group by 1""")
def j12c(spark, sf_dir):
    return q.offenders(spoiled(fixtures.panel(spark, sf_dir)), "consumer_type", CONSUMER_TYPES)
