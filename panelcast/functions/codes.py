"""Dictionary encoding."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F


def encode(column, codes: dict, to: str = "tinyint") -> Column:
    """Code of a value in a small fixed dictionary; a value outside it fails the job.

    NULL also fails, because a NULL has no code.
    """
    value = F.col(column) if isinstance(column, str) else column
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(codes.items())])
    unknown = F.raise_error(F.concat(F.lit("no code for value: "), F.coalesce(value, F.lit("NULL"))))
    return F.coalesce(F.try_element_at(table, value), unknown.cast("int")).cast(to)
