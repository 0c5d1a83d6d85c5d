"""Arrays and JSON for result pages."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def ordered_pairs(time: Column, value: Column) -> Column:
    """Aggregate: (time, value) structs of a bounded group in time order."""
    return F.array_sort(F.collect_list(F.struct(time.alias("t"), value.alias("v"))))


def field_of(pairs, name: str) -> Column:
    """One field of an array of structs, as its own array."""
    pairs = F.col(pairs) if isinstance(pairs, str) else pairs
    return pairs.getField(name)


def as_json(*columns: str) -> Column:
    return F.to_json(F.struct(*columns))
