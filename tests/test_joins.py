import pytest
from pyspark.sql import functions as F

from orestrata.operators.joins import left_fan_out, left_lookup


def test_fan_out_keeps_heads_without_details_and_null_keys(spark, rows):
    heads = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, h string")
    details = spark.createDataFrame([(1, 10), (1, 11), (None, 12), (9, 13)], "k int, d int")
    joined = left_fan_out(heads, details, "k")
    assert joined.columns == ["k", "h", "d"]
    assert rows(joined) == [(None, "c", None), (1, "a", 10), (1, "a", 11), (2, "b", None)]


def test_fan_out_takes_any_key_type(spark):
    keys = spark.range(2000).select(F.encode(F.col("id").cast("string"), "utf-8").alias("k"), "id")
    heads = keys.select("k", F.col("id").alias("h"))
    details = keys.filter("id < 1500").select("k", F.explode(F.sequence(F.lit(1), F.lit(20))).alias("d"))
    joined = left_fan_out(heads, details, "k")
    assert joined.count() == 1500 * 20 + 500 and joined.filter("d IS NULL").count() == 500


def test_lookup_keeps_rows_without_a_match(spark, rows):
    facts = spark.createDataFrame([(1, 5), (None, 6), (3, 7)], "k int, f int")
    lookup = spark.createDataFrame([(1, "x"), (None, "y")], "k int, l string")
    assert rows(left_lookup(facts, lookup, "k")) == [(None, 6, None), (1, 5, "x"), (3, 7, None)]


def test_empty_sides(spark):
    heads = spark.createDataFrame([(1, "a")], "k int, h string")
    details = spark.createDataFrame([], "k int, d int")
    assert left_fan_out(heads, details, "k").count() == 1
    assert left_fan_out(heads.limit(0), details, "k").count() == 0


def test_shared_columns_are_refused(spark):
    left = spark.createDataFrame([(1, 2)], "k int, v int")
    with pytest.raises(ValueError, match="v"):
        left_lookup(left, left, "k")
    with pytest.raises(ValueError, match="v"):
        left_fan_out(left, left, "k")


def _skewed(spark, n):
    """Details of which one key owns a third, and one head per key."""
    details = spark.range(n, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 5000)).alias("k"),
        F.col("id").alias("d"),
    )
    heads = spark.range(6000).select(
        F.concat(F.lit("k"), "id").alias("k"), F.lit("h").alias("h")
    ).unionAll(spark.createDataFrame([("hot", "H")], "k string, h string"))
    return heads, details


def test_hot_key_gives_the_rows_of_a_left_join(spark):
    heads, details = _skewed(spark, 90_000)
    got = left_fan_out(heads, details, "k")
    want = heads.join(details, "k", "left")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert got.count() == 91_000


# Sizes of a cluster scaled down to the test: nothing small enough to broadcast, and 20 KB
# enough to call a partition skewed.
SCALED_DOWN = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def test_hot_lookup_key_is_split_over_tasks(spark, conf):
    conf(SCALED_DOWN)
    lookup, facts = _skewed(spark, 90_000)
    joined = left_lookup(facts, lookup, "k")
    assert len(joined.collect()) == 90_000
    assert "SortMergeJoin(skew=true)" in joined._jdf.queryExecution().executedPlan().toString()


def test_hot_key_is_split_over_tasks(spark, conf):
    conf(SCALED_DOWN)
    heads, details = _skewed(spark, 90_000)
    joined = left_fan_out(heads, details, "k")
    joined.collect()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in plan


def test_heads_without_details_are_found_without_sorts(spark, conf, rows):
    """Ids of millions of heads share a task: beside their distinct table nothing is sorted."""
    conf({"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
    heads = spark.createDataFrame([(1, "a"), (2, "b"), (2, "bb"), (None, "c")], "k int, h string")
    details = spark.createDataFrame([(1, 10), (1, 11), (1, 10), (None, 12)], "k int, d int")
    joined = left_fan_out(heads, details, "k")
    assert rows(joined) == [(None, "c", None), (1, "a", 10), (1, "a", 10), (1, "a", 11), (2, "b", None), (2, "bb", None)]
    plan = joined._jdf.queryExecution().executedPlan().toString()
    anti = [line for line in plan.split("\n") if "LeftAnti" in line]
    assert anti and all("ShuffledHashJoin" in line for line in anti)
