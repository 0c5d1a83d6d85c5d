"""Declared expectations on the clean panel."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from panelcast.functions.hours import to_hour
from panelcast.schemas import AREA_CODES, CONSUMER_TYPES


@dataclass(frozen=True)
class Expectation:
    """A named rule on a column.

    ``failing`` marks the rows that break it; ``schema_ok`` is decided from the schema alone.
    """

    name: str
    column: str
    failing: Column | None = None
    schema_ok: bool | None = None


def columns_match(df: DataFrame, expected) -> Expectation:
    return Expectation("columns_match_ordered_list", ",".join(expected), schema_ok=df.columns == list(expected))


def column_count(df: DataFrame, expected: int) -> Expectation:
    return Expectation("column_count", "*", schema_ok=len(df.columns) == expected)


def has_type(df: DataFrame, column: str, expected: str) -> Expectation:
    found = dict(df.dtypes).get(column)
    return Expectation(f"type_is_{expected}", column, schema_ok=found == expected)


def not_null(column: str) -> Expectation:
    return Expectation("not_null", column, failing=F.col(column).isNull())


def in_set(column: str, allowed) -> Expectation:
    """NULL is not a member and not an offender either."""
    return Expectation("in_set", column, failing=~F.col(column).isin(*allowed))


def at_least(column: str, lowest: float) -> Expectation:
    return Expectation("at_least", column, failing=F.col(column) < lowest)


def full_hours(column: str) -> Expectation:
    return Expectation("full_hours", column, failing=F.col(column) != to_hour(column))


def panel_suite(df: DataFrame) -> list[Expectation]:
    """The rules of the clean panel; rules on an absent column are reported by the column rules."""
    rules = [
        columns_match(df, ("datetime_utc", "area", "consumer_type", "energy_consumption")),
        column_count(df, 4),
        not_null("datetime_utc"),
        in_set("area", AREA_CODES.values()),
        has_type(df, "area", "tinyint"),
        in_set("consumer_type", CONSUMER_TYPES),
        has_type(df, "consumer_type", "int"),
        at_least("energy_consumption", 0.0),
        has_type(df, "energy_consumption", "double"),
        not_null("energy_consumption"),
        full_hours("datetime_utc"),
    ]
    return [r for r in rules if r.schema_ok is not None or r.column in df.columns]


REPORT = "check string, column string, ok boolean, bad_count bigint, rows_checked bigint"


def validate(df: DataFrame, suite: list[Expectation]) -> DataFrame:
    """One row (check, column, ok, bad_count, rows_checked) per rule, from one aggregate over the table."""
    def bad(rule: Expectation) -> Column:
        if rule.failing is None:
            return F.lit(0 if rule.schema_ok else 1).cast("bigint")
        return F.count_if(rule.failing)

    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[bad(r).alias(f"_bad{i}") for i, r in enumerate(suite)]
    )
    rows = F.array(*[
        F.struct(
            F.lit(r.name).alias("check"), F.lit(r.column).alias("column"),
            (F.col(f"_bad{i}") == 0).alias("ok"), F.col(f"_bad{i}").alias("bad_count"),
            F.col("_rows").alias("rows_checked"),
        )
        for i, r in enumerate(suite)
    ])
    return counted.select(F.inline(rows))


def offenders(df: DataFrame, column: str, allowed) -> DataFrame:
    """Distinct values outside the allowed set with their row counts."""
    return df.filter(~F.col(column).isin(*allowed)).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))


def quarantine(df: DataFrame, suite: list[Expectation]) -> tuple[DataFrame, DataFrame]:
    """(rows that pass every row rule, rows that break at least one)."""
    failing = F.lit(False)
    for rule in suite:
        if rule.failing is not None:
            failing = failing | F.coalesce(rule.failing, F.lit(False))
    return df.filter(~failing), df.filter(failing)


def enforce(
    df: DataFrame, suite: list[Expectation], policy: str = "fail", rejected: str | None = None, report: str | None = None,
) -> DataFrame:
    """Apply a policy: ``fail`` raises, ``warn`` passes all rows on, ``quarantine`` keeps the good rows.

    ``report`` is a table that the report of every run is appended to; ``warn`` needs it. Rows that
    ``quarantine`` takes out are appended to the table ``rejected``, which it needs; a rule about the
    schema can't be met by taking rows out and raises. Only the report, one row per rule, comes to
    the driver.
    """
    if policy not in ("fail", "warn", "quarantine"):
        raise ValueError(f"unknown policy {policy!r}")
    if policy == "quarantine" and rejected is None or policy == "warn" and report is None:
        raise ValueError(f"policy {policy!r} needs a table for what it finds")
    rows = validate(df, suite).collect()
    if report is not None:
        found = df.sparkSession.createDataFrame(rows, REPORT).withColumn("checked_at", F.current_timestamp())
        found.coalesce(1).write.mode("append").parquet(report)
    broken = [r for r, rule in zip(rows, suite) if not r["ok"] and (policy == "fail" or policy == "quarantine" and rule.failing is None)]
    if broken:
        raise ValueError("expectations not met: " + "; ".join(f"{r['check']}({r['column']}): {r['bad_count']}" for r in broken))
    if policy == "quarantine" and any(not r["ok"] for r in rows):
        good, bad = quarantine(df, suite)
        bad.write.mode("append").parquet(rejected)
        return good
    return df
