import pytest
from pyspark.sql import functions as F

from orestrata.operators.dedup import drop_copies, drop_null_keys, latest_per_key
from orestrata.operators.upsert import upsert

SCHEMA = "k int, v string, t int"


def test_copies(spark, rows):
    df = spark.createDataFrame([(1, "a", 1), (1, "a", 1), (None, None, 1), (None, None, 1), (1, "a", 2)], SCHEMA)
    assert rows(drop_copies(df)) == [(None, None, 1), (1, "a", 1), (1, "a", 2)]


def test_latest_per_key(spark, rows):
    df = spark.createDataFrame(
        [(1, "a", 1), (1, "b", 3), (1, "c", 2), (None, "x", 1), (None, "y", 2), (2, "q", 5), (2, "p", 5)], SCHEMA
    )
    assert rows(latest_per_key(df, ["k"], [F.desc("t")])) == [(None, "y", 2), (1, "b", 3), (2, "p", 5)]


def test_latest_per_hot_key_reduces_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), F.col("id").alias("t"))
    plan = latest_per_key(df, ["k"], [F.desc("t")])._jdf.queryExecution().executedPlan().toString()
    partial = plan.index("Partial")
    assert "WindowGroupLimit" in plan[:partial] and plan.index("Exchange") < partial


def test_null_keys(spark, rows):
    df = spark.createDataFrame([(1, None, 1), (None, "a", 1), (2, "b", None)], SCHEMA)
    assert rows(drop_null_keys(df, ["k", "v"])) == [(2, "b", None)]


def test_upsert(spark, rows):
    base = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (2, "bb", 1), (None, "n", 1)], SCHEMA)
    updates = spark.createDataFrame([(2, "B", 2), (3, "C", 2), (None, "N", 2)], SCHEMA)
    assert rows(upsert(base, updates, ["k"])) == [(None, "N", 2), (1, "a", 1), (2, "B", 2), (3, "C", 2)]
    assert rows(upsert(base, updates.limit(0), ["k"])) == rows(base)
    assert rows(upsert(base.limit(0), updates, ["k"])) == rows(updates)


def test_upsert_on_two_keys(spark, rows):
    base = spark.createDataFrame([(1, "a", 1), (1, None, 1)], SCHEMA)
    updates = spark.createDataFrame([(1, None, 9), (1, "b", 9)], SCHEMA)
    assert rows(upsert(base, updates, ["k", "v"])) == [(1, None, 9), (1, "a", 1), (1, "b", 9)]


def test_two_updates_of_one_key_are_an_error(spark):
    base = spark.createDataFrame([(1, "a", 1)], SCHEMA)
    updates = spark.createDataFrame([(7, "x", 1), (7, "y", 1)], SCHEMA)
    with pytest.raises(Exception, match="several updates"):
        upsert(base, updates, ["k"]).collect()
    with pytest.raises(Exception, match="several updates"):
        upsert(base, updates, ["k"]).count()
