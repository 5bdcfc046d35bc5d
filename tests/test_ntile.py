import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from orestrata.operators.ntile import Bracket, Orderings, bucket_ends, with_ntiles
from orestrata.sources.scratch import materialize


def _by_window(df, buckets, columns):
    return df.withColumn("want", F.ntile(buckets).over(Window.orderBy(*[c.asc_nulls_first() for c in columns])))


def _mismatches(df, buckets, columns, **bounds):
    want = _by_window(materialize(df), buckets, columns)
    return with_ntiles(want, buckets, {"got": columns}, **bounds).filter(~F.col("got").eqNullSafe(F.col("want")))


@pytest.mark.parametrize("buckets", [4, 7])
@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 10, 1003])
def test_small_tables(spark, n, buckets):
    df = spark.range(n).withColumn("v", F.when(F.col("id") % 5 != 0, F.col("id") % 3))
    columns = [F.col("v"), F.col("id")]
    assert _mismatches(df, buckets, columns).count() == 0


@pytest.mark.parametrize(("n", "buckets", "bound"), [(1003, 4, 100), (20011, 4, 400), (20011, 7, 900), (601, 10, 300)])
def test_narrowing_equals_the_window(spark, n, buckets, bound):
    """NULLs, a value that a third of the rows share, and a descending number."""
    df = spark.range(n, numPartitions=5).select(
        F.xxhash64("id").cast("string").alias("key"),
        F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 11 != 0, F.pmod(F.hash("id"), F.lit(97))).alias("v"),
    )
    columns = [F.col("v").isNull(), -F.col("v"), F.col("key")]
    assert _mismatches(df, buckets, columns, sort_rows=bound, sample_rows=bound).count() == 0


@pytest.mark.parametrize("n", [5, 6, 7, 8])
def test_brackets_of_a_few_rows(spark, n):
    assert _mismatches(spark.range(n), 4, [F.col("id")], sort_rows=4, sample_rows=2).count() == 0


@pytest.mark.parametrize("kind", ["decimal(20,4)", "double", "date", "timestamp_ntz", "string"])
def test_key_types(spark, kind):
    value = F.timestamp_seconds(F.col("id") * 86_400) if kind in ("date", "timestamp_ntz") else F.col("id") / 8
    df = spark.range(300).select("id", value.cast(kind).alias("v"))
    assert _mismatches(df, 4, [F.col("v"), F.col("id")], sort_rows=100, sample_rows=100).count() == 0


def test_nan_and_infinity_sort_last(spark):
    special = F.when(F.col("id") % 4 == 0, F.lit(float("nan"))).when(F.col("id") % 4 == 1, F.lit(float("inf")))
    df = spark.range(400).withColumn("v", F.coalesce(special, F.col("id").cast("double")))
    assert _mismatches(df, 4, [F.col("v"), F.col("id")], sort_rows=100, sample_rows=100).count() == 0


def test_several_orderings_at_once(spark):
    df = spark.range(5000).select("id", F.pmod(F.hash("id"), F.lit(10)).alias("a"), F.rand(1).alias("b"))
    orderings = {"x": [F.col("a"), F.col("id")], "y": [F.col("b"), F.col("id")], "z": [-F.col("id")]}
    scored = with_ntiles(df, 4, orderings, sort_rows=500, sample_rows=500)
    sizes = scored.groupBy("x").count().collect()
    assert {r.x: r["count"] for r in sizes} == {1: 1250, 2: 1250, 3: 1250, 4: 1250}
    bounds = scored.groupBy("y").agg(F.min("b").alias("low"), F.max("b").alias("high")).orderBy("y").collect()
    assert all(a.high < b.low for a, b in zip(bounds, bounds[1:], strict=False))
    assert scored.filter("z != 4 - id div 1250").count() == 0


def test_large_table_is_scored_without_a_shuffle(spark):
    table = materialize(spark.range(1000))
    scored = with_ntiles(table, 4, {"s": [F.col("id")]}, stable=True, sort_rows=200, sample_rows=200)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_ties_at_a_bucket_end_are_an_error(spark):
    df = spark.range(1000).withColumn("v", F.lit(1))
    with pytest.raises(ValueError, match="unique"):
        with_ntiles(df, 4, {"s": [F.col("v")]}, sort_rows=100, sample_rows=100)


def test_types_that_change_in_python_are_refused(spark):
    df = spark.range(10).withColumn("t", F.timestamp_seconds("id"))
    with pytest.raises(TypeError, match="timestamp"):
        with_ntiles(df, 4, {"s": [F.col("t")]})


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    values=st.lists(st.one_of(st.none(), st.integers(-3, 3)), min_size=1, max_size=60),
    buckets=st.integers(1, 9),
)
def test_any_values(spark, values, buckets):
    df = spark.createDataFrame(list(enumerate(values)), "id long, v int")
    assert _mismatches(df, buckets, [F.col("v"), F.col("id")], sort_rows=20, sample_rows=20).count() == 0


@given(st.integers(0, 500), st.integers(1, 20))
def test_bucket_ends(rows, buckets):
    marks = [0, *bucket_ends(rows, buckets), rows]
    sizes = [b - a for a, b in zip(marks, marks[1:], strict=False)]
    assert sum(sizes) == rows and sizes == sorted(sizes, reverse=True)
    assert len(sizes) == max(1, min(rows, buckets))
    assert max(sizes) - min(sizes) <= 1


def _jobs(spark, run):
    """Jobs that the context has started while running."""
    tracker, group = spark.sparkContext.statusTracker(), f"jobs-{run.__name__}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        run()
        return len(tracker.getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setJobGroup(None, None)


def test_three_orderings_cost_the_scans_and_jobs_of_one(spark):
    table = materialize(spark.range(3000).select("id", (F.col("id") % 7).alias("a"), (F.col("id") % 5).alias("b")))
    keys = {"x": [F.col("a"), F.col("id")], "y": [F.col("b"), F.col("id")], "z": [F.col("id")]}
    bounds = {"stable": True, "sort_rows": 500, "sample_rows": 500}

    def one():
        with_ntiles(table, 4, {"x": keys["x"]}, **bounds)

    def three():
        with_ntiles(table, 4, keys, **bounds)

    assert _jobs(spark, three) == _jobs(spark, one)
    ranked = Orderings(table, keys).ranked([Bracket(n, None, None, 0, 3000, (9,)) for n in keys], [1.0] * 3, 0)
    plan = ranked._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and plan.count("Window [") == 1
