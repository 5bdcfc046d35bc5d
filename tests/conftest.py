import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from orestrata.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        {"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "4g", "spark.log.level": "ERROR"},
    )
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a DataFrame as a sorted list of tuples, NULLs first."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted(map(tuple, picked.collect()), key=lambda r: [(v is not None, v) for v in r])

    return collect


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def change(options):
        for key, value in options.items():
            before[key] = spark.conf.get(key, None)
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)
