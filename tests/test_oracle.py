"""Every registered query against its SQL on the given tables."""

import math
import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as registered

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# The queries of the subpackage, if it is there, have tests of their own.
ADDED = {*registered.llm.queries(), "pipeline"} if registered.llm else set()
OWN = [name for name in registered.queries() if name not in ADDED]
TABLES = ("customer", "lineitem", "orders", "part")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def _value(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def _table(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    plain = [tuple(_value(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(plain, key=lambda r: [(v is not None, v) for v in r])


@pytest.mark.parametrize("name", OWN)
def test_query_matches_sql(spark, sql, name):
    got = registered.queries()[name](spark, SF_DIR)
    cursor = sql.execute(registered.oracle_sql()[name])
    want = _table([column[0] for column in cursor.description], cursor.fetchall())
    assert _table(got.columns, got.collect()) == want


def test_every_query_has_sql():
    assert set(OWN) <= set(registered.oracle_sql())


def test_entry(spark):
    segments = registered.entry(spark)
    assert segments.count() == 150
    assert segments.columns[0] == "customer_unique_id"


def test_anchor_counts(spark):
    """Segment sizes at sf0.01, known from an earlier independent computation."""
    report = registered.queries()["segment_distribution"](spark, "/root/testdata/sf0.01")
    assert {r.rfm_segment: (r.customer_count, r.avg_monetary) for r in report.collect()} == {
        "Champions/VIP": (108, 2441918.53),
        "Recent Customers": (266, 1344698.97),
        "Loyal Customers": (236, 2207283.11),
        "Big Spenders": (77, 2094051.45),
        "Lost Customers": (324, 1033313.38),
        "At Risk": (255, 1174996.79),
        "General Customers": (233, 1187681.94),
    }
