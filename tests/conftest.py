"""Shared Spark session for the tests (local, 8 shuffle partitions, UI off)."""

from __future__ import annotations

import pytest

from quadra.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("*", shuffle_partitions=8)
    yield session


@pytest.fixture()
def scratch(tmp_path):
    """A fresh local folder for one test's lake (tests only; jobs use the
    cluster's checkpoint dir)."""
    return str(tmp_path)
