import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

from rowmill.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "rowmill-tests")
    session.sparkContext.setLogLevel("ERROR")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture
def small_tasks(monkeypatch):
    """Make every group count as big, so the sliced and salted forms run."""
    from rowmill.operators import joins

    monkeypatch.setattr(joins, "TASK_ROWS", 120)
    monkeypatch.setattr(joins, "SMALL_BYTES", 0)
