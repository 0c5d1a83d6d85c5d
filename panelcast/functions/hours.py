"""Hour arithmetic on zone-free timestamps. The session time zone is UTC."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from panelcast.schemas import RAW_TIME_FORMAT


def _column(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def ntz(value) -> Column:
    """Literal of a Python datetime or ISO text as ``timestamp_ntz``; a Column is passed through."""
    if isinstance(value, Column):
        return value
    return F.lit(str(value)).cast("timestamp_ntz")


def _origin() -> Column:
    return F.expr("timestamp_ntz'1970-01-01 00:00:00'")


def to_hour(time) -> Column:
    return F.date_trunc("hour", _column(time)).cast("timestamp_ntz")


def to_second(time) -> Column:
    return F.date_trunc("second", _column(time)).cast("timestamp_ntz")


def epoch_hour(time) -> Column:
    """Hours since 1970-01-01 of a timestamp, as bigint."""
    return F.timestamp_diff("HOUR", _origin(), _column(time))


def from_epoch_hour(hours) -> Column:
    return F.timestamp_add("HOUR", _column(hours).cast("int"), _origin())


def add_hours(time, hours) -> Column:
    hours = F.lit(hours) if isinstance(hours, int) else _column(hours)
    return F.timestamp_add("HOUR", hours.cast("int"), _column(time))


def add_days(time, days) -> Column:
    days = F.lit(days) if isinstance(days, int) else _column(days)
    return F.timestamp_add("DAY", days.cast("int"), _column(time))


def parse_time(text, fmt: str = RAW_TIME_FORMAT) -> Column:
    """Strict parse: text in another format raises (ANSI mode)."""
    return F.to_timestamp_ntz(_column(text), F.lit(fmt))


def format_time(time, fmt: str = RAW_TIME_FORMAT) -> Column:
    return F.date_format(_column(time), fmt)


def iso_text(time) -> Column:
    return format_time(time, "yyyy-MM-dd'T'HH:mm:ss")


def clamp(value, lower=None, upper=None) -> Column:
    column = _column(value)
    if upper is not None:
        column = F.least(column, upper)
    if lower is not None:
        column = F.greatest(column, lower)
    return column


def parse_logical_date(text) -> Column:
    """Wall-clock second of a run's logical date, with or without a fraction.

    The zone offset is dropped, not applied. Text in neither form raises.
    """
    wall_clock = F.regexp_replace(_column(text), r"([+-]\d{2}:?\d{2}|Z)$", "")
    seconds_only = F.regexp_replace(wall_clock, r"\.\d{1,6}$", "")
    return F.to_timestamp_ntz(seconds_only, F.lit("yyyy-MM-dd HH:mm:ss"))


def day_of_week(time) -> Column:
    """Monday is 0."""
    return F.weekday(_column(time))


def hour_of_day(time) -> Column:
    return F.hour(_column(time))
