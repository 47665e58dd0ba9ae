import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from plumbline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        spark__driver__memory="8g",
        spark__sql__shuffle__partitions=8,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Collect a frame as sorted tuples."""

    def collect(frame, *columns):
        picked = frame.select(*columns) if columns else frame
        return sorted([tuple(r) for r in picked.collect()], key=repr)

    return collect


@pytest.fixture
def plan():
    """The physical plan of a frame as text."""
    return lambda frame: frame._jdf.queryExecution().executedPlan().toString()
