from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tokentally.session import local_session, remove_scratch  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, app="tokentally-tests", **{"spark.sql.shuffle.partitions": "8"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    remove_scratch(session)
    session.stop()
