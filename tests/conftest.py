import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from partledger.context import RunContext  # noqa: E402
from partledger.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g"})
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def ctx():
    return RunContext("t1", datetime(2026, 4, 1, 6, 0, 0))


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples of text."""
    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted(tuple(str(v) for v in r) for r in picked.collect())

    return collect
