"""Registration of queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function: Callable) -> Callable:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function
    return register


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Averages and ratios are compared to a fixed number of decimals."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


def listed(column, kind: str = "string"):
    """Array as comma-separated text, so that both engines compare the same value."""
    return F.array_join(F.transform(column, lambda x: x.cast(kind).cast("string")), ",")


MONEY = "decimal(18,2)"


def lists_as_text(df: DataFrame, whole=(), decimal=()) -> DataFrame:
    columns = {c: listed(F.col(c)) for c in whole}
    columns.update({c: listed(F.col(c), MONEY) for c in decimal})
    return df.withColumns(columns)
