from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    from bowline.staging import release_staged

    release_staged(session)
    session.stop()


@pytest.fixture
def no_broadcast(monkeypatch):
    """Every lookup table counts as too large to broadcast."""
    monkeypatch.setattr("bowline.staging.BROADCAST_ROWS", -1)


def rows_of(df) -> list[tuple]:
    """All rows as sorted tuples, arrays as tuples."""
    plain = [tuple(tuple(v) if isinstance(v, list) else v for v in row) for row in df.collect()]
    return sorted(plain, key=lambda row: [(v is None, str(type(v)), v if v is not None else 0) for v in row])
