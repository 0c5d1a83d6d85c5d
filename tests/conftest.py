import os
import sys
from datetime import datetime, timedelta

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from panelcast.schemas import PANEL  # noqa: E402
from panelcast.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make_panel(spark):
    """Panel rows from (hour offset from Monday 2024-01-01, value) pairs per series."""
    def make(series: dict):
        rows = [
            (_hour(h), a, c, v)
            for (a, c), points in series.items() for h, v in points
        ]
        return spark.createDataFrame(rows, PANEL)
    return make


def _hour(offset: int) -> datetime:
    return datetime(2024, 1, 1) + timedelta(hours=offset)


@pytest.fixture
def hour():
    return _hour
