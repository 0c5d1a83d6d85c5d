"""One registered query per operator, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from panelcast.queries.registry import ORACLES, QUERIES


def load() -> tuple[dict[str, Callable], dict[str, str]]:
    from panelcast.queries import (  # noqa: F401
        aggregation, cleaning, extension, extraction, forecasting, joining, pages, quality, scalars,
        storage, streams, timeseries, users,
    )
    return dict(sorted(QUERIES.items())), dict(sorted(ORACLES.items()))
