from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orestrata.functions.segments import score_string, segment
from orestrata.plans import reports, rfm, silver

SALES = (
    "customer_unique_id string, order_id string, order_purchase_timestamp timestamp_ntz, "
    "price decimal(18,2), freight_value decimal(18,2)"
)


def _sales(spark, *rows):
    money = [
        (person, order, when, *(None if v is None else Decimal(v) for v in amounts))
        for person, order, when, *amounts in rows
    ]
    return spark.createDataFrame(money, SALES)


def _day(day, hour=0, minute=0):
    return datetime(2018, 1, day, hour, minute)


def _metrics(df):
    return {r.customer_unique_id: (r.recency, r.frequency, r.monetary) for r in df.collect()}


def test_metrics(spark):
    sales = _sales(
        spark,
        ("a", "1", _day(5), "10.00", "1.50"),
        ("a", "1", _day(5), "20.00", None),
        ("a", "2", _day(9), "5.25", "0.25"),
        ("b", "3", _day(10), None, None),
        (None, "4", _day(1), "1.00", "0.00"),
        (None, "5", _day(2), "1.00", "0.00"),
    )
    assert _metrics(rfm.rfm_base(sales)) == {
        "a": (2, 2, 17.0), "b": (1, 1, None), None: (9, 2, 2.0),
    }


def test_whole_numbers_of_minor_units_give_the_same_metrics(spark):
    sales = _sales(
        spark, ("a", "1", _day(1), "0.10", "0.20"), ("a", "2", _day(2), "1.07", None), ("b", "3", _day(3), "9.99", "0.01")
    )
    cents = sales.withColumn("cents", F.expr("cast((price + freight_value) * 100 as bigint)"))
    assert _metrics(rfm.rfm_base(cents, "cents", units=100)) == _metrics(rfm.rfm_base(sales))


def test_recency_counts_dates_not_hours(spark):
    sales = _sales(
        spark, ("a", "1", _day(3, 23, 59), "1", "1"), ("b", "2", _day(4, 0, 1), "1", "1"), ("c", "3", None, "1", "1")
    )
    recency = {person: metrics[0] for person, metrics in _metrics(rfm.rfm_base(sales)).items()}
    assert recency == {"a": 2, "b": 1, "c": None}


def test_no_sales(spark):
    empty = _sales(spark).limit(0)
    assert rfm.rfm_segments(empty).count() == 0
    assert rfm.reference_date(empty).first().reference_date is None


def test_order_totals_equal_the_denormalized_table(spark):
    """Also for an order stored twice, two records of one person, and a missing customer."""
    orders = spark.createDataFrame(
        [("1", "c1", "x", _day(1)), ("1", "c1", "x", _day(1)), ("2", "c2", "x", _day(2)), ("3", "c9", "x", _day(3)),
         ("4", "c2", "x", _day(4))],
        "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz",
    )
    customers = spark.createDataFrame([("c1", "p"), ("c2", "p")], "customer_id string, customer_unique_id string")
    items = spark.createDataFrame(
        [("1", "x", Decimal("1.10"), Decimal("0.20")), ("1", "y", Decimal("2.00"), None),
         ("2", "x", Decimal("5.00"), Decimal("0.01")), ("3", "z", Decimal("7.00"), Decimal("1.00"))],
        "order_id string, product_id string, price decimal(18,2), freight_value decimal(18,2)",
    )
    products = spark.createDataFrame([("x", "toys"), ("y", "art")], "product_id string, category string")
    wide = rfm.rfm_base(silver.denormalize(orders, customers, items, products))
    slim = rfm.rfm_base(rfm.order_sales(orders, customers, items), "amount")
    assert _metrics(wide) == _metrics(slim) == {"p": (1, 3, 7.61), None: (2, 1, 8.0)}
    assert wide.schema == slim.schema


@pytest.mark.parametrize("bounds", [{}, {"sort_rows": 2, "sample_rows": 2}])
def test_scores_put_missing_values_at_the_right_end(spark, bounds):
    base = spark.createDataFrame(
        [("a", 1, 1, None), ("b", 2, 1, 5.0), ("c", 3, 1, 6.0), ("d", None, 1, 7.0)],
        "customer_unique_id string, recency int, frequency long, monetary double",
    )
    scores = rfm.rfm_scores(base, **bounds)
    assert {r.customer_unique_id: r.rfm_score_string for r in scores.collect()} == {
        "a": "311", "b": "222", "c": "133", "d": "444",
    }


@pytest.mark.parametrize(
    ("scores", "label"),
    [
        ((4, 4, 4), "Champions/VIP"),
        ((4, 4, 3), "Recent Customers"),
        ((4, 1, 1), "Recent Customers"),
        ((1, 4, 4), "Loyal Customers"),
        ((3, 4, 1), "Loyal Customers"),
        ((1, 3, 4), "Big Spenders"),
        ((1, 3, 3), "Lost Customers"),
        ((2, 3, 3), "At Risk"),
        ((3, 3, 3), "General Customers"),
    ],
)
def test_first_rule_that_holds_names_the_segment(spark, scores, label):
    df = spark.createDataFrame([scores], "r_score int, f_score int, m_score int")
    assert df.withColumn("rfm_score_string", score_string()).select(segment()).first()[0] == label


def test_segments_cover_every_person_once(spark):
    sales = spark.range(500).select(
        (F.col("id") % 97).cast("string").alias("customer_unique_id"),
        F.col("id").cast("string").alias("order_id"),
        F.expr("timestamp_ntz'2018-01-01' + make_dt_interval(cast(id % 31 as int))").alias("order_purchase_timestamp"),
        F.col("id").cast("decimal(18,2)").alias("price"),
        F.lit(1).cast("decimal(18,2)").alias("freight_value"),
    )
    plain, narrowed = rfm.rfm_segments(sales), rfm.rfm_segments(sales, sort_rows=40, sample_rows=40)
    assert plain.select("customer_unique_id").distinct().count() == plain.count() == 97
    assert plain.exceptAll(narrowed).isEmpty()
    assert plain.columns == [
        "customer_unique_id", "last_purchase_date", "frequency", "monetary", "recency",
        "r_score", "f_score", "m_score", "rfm_score_string", "rfm_segment",
    ]
    types = dict(plain.dtypes)
    assert types["frequency"] == "bigint" and types["recency"] == types["r_score"] == "int"
    assert plain.filter("r_score is null or f_score is null or m_score is null").isEmpty()


def test_distribution(spark):
    segments = spark.createDataFrame(
        [("At Risk", 1.0, 1, 1), ("At Risk", 2.01, 2, 2), ("Loyal", None, 3, 3), ("Big", 1.005, 1, 1)],
        "rfm_segment string, monetary double, recency int, frequency long",
    )
    assert [tuple(r) for r in reports.segment_distribution(segments).collect()] == [
        ("At Risk", 2, 1.51, 1.5, 1.5), ("Big", 1, 1.01, 1.0, 1.0), ("Loyal", 1, None, 3.0, 3.0),
    ]
    assert reports.segment_distribution(segments, ["monetary"]).columns == [
        "rfm_segment", "customer_count", "avg_monetary",
    ]


def test_top_customers_break_ties_by_person(spark):
    segments = spark.createDataFrame(
        [("b", 1, 5.0, 1, "Champions/VIP"), ("a", 1, 5.0, 1, "Champions/VIP"), ("c", 1, None, 1, "Champions/VIP"),
         ("d", 1, 9.0, 1, "At Risk")],
        "customer_unique_id string, frequency long, monetary double, recency int, rfm_segment string",
    )
    assert [r.customer_unique_id for r in reports.top_customers(segments, n=3).collect()] == ["a", "b", "c"]
