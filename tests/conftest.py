from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from linkloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", local_cores=8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    changed = {}

    def put(key: str, value: str) -> None:
        changed.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield put
    for key, value in changed.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)
