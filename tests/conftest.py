from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from swishline.session import local_session

    session = local_session(8, "tests")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Rows of a frame as a sorted list of tuples."""

    def collect(df):
        return sorted((tuple(r) for r in df.collect()), key=str)

    return collect


@pytest.fixture(scope="session")
def plays(spark):
    from contract import bindings

    return bindings.plays(spark, SMALL).persist()


@pytest.fixture(scope="session")
def telemetry(spark):
    from contract import bindings

    return bindings.telemetry(spark, SMALL).persist()
