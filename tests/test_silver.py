from datetime import datetime

from pyspark.sql import functions as F

from orestrata.plans import reports, silver

ORDERS = (
    "order_id string, customer_id string, order_status string, order_purchase_timestamp string, "
    "order_approved_at string, order_delivered_carrier_date string, "
    "order_delivered_customer_date string, order_estimated_delivery_date string"
)


def _orders(spark, *rows):
    """Orders given as (id, customer, status, delivered, estimated)."""
    placed = "2018-01-01 10:00:00"
    return spark.createDataFrame([(i, c, s, placed, placed, None, d, e) for i, c, s, d, e in rows], ORDERS)


def test_excluded_and_unknown_status_are_dropped(spark, rows):
    orders = _orders(
        spark, ("1", "a", "canceled", None, None), ("2", "a", None, None, None), ("3", "a", "shipped", None, None)
    )
    assert rows(silver.keep_orders(orders), "order_id") == [("3",)]


def test_delivery_is_filled_before_it_is_parsed(spark, rows):
    early, late = "2018-01-02 00:00:00", "2018-01-09 00:00:00"
    orders = _orders(
        spark,
        ("1", "a", "x", early, late),
        ("2", "a", "x", None, late),
        ("3", "a", "x", None, None),
        ("4", "a", "x", "no date", late),
    )
    cleaned = silver.clean_orders(orders)
    assert dict(cleaned.dtypes)["order_delivered_customer_date"] == "timestamp"
    assert rows(cleaned, "order_id", F.date_format("order_delivered_customer_date", "yyyy-MM-dd")) == [
        ("1", "2018-01-02"), ("2", "2018-01-09"), ("3", None), ("4", None),
    ]


def test_typed_times_are_left_alone(spark):
    orders = spark.createDataFrame(
        [("1", "x", datetime(2018, 1, 1), None, datetime(2018, 1, 3))],
        "order_id string, order_status string, order_purchase_timestamp timestamp_ntz, "
        "order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz",
    )
    cleaned = silver.clean_orders(orders)
    assert cleaned.schema == orders.schema
    assert cleaned.first().order_delivered_customer_date == datetime(2018, 1, 3)


def _star(spark):
    orders = _orders(
        spark,
        ("o1", "c1", "delivered", None, None),
        ("o2", "c1", "delivered", None, None),
        ("o3", "c9", "delivered", None, None),
        ("o4", "c1", "canceled", None, None),
    )
    customers = spark.createDataFrame([("c1", "p1"), ("c2", "p2")], "customer_id string, customer_unique_id string")
    items = spark.createDataFrame(
        [("o1", "x", 1.0, 0.5), ("o1", "y", 2.0, 0.5), ("o3", None, 3.0, 0.5), ("o4", "x", 4.0, 0.5)],
        "order_id string, product_id string, price double, freight_value double",
    )
    products = spark.createDataFrame([("x", "toys")], "product_id string, product_category_name string")
    return orders, customers, items, products


def test_star_join(spark, rows):
    sales = silver.build_silver(*_star(spark))
    assert sales.columns[:3] == ["product_id", "order_id", "customer_id"]
    assert len(sales.columns) == len(set(sales.columns)) == 8 + 1 + 3 + 1
    picked = rows(sales, "order_id", "product_id", "customer_unique_id", "price", "product_category_name")
    assert picked == [
        ("o1", "x", "p1", 1.0, "toys"),
        ("o1", "y", "p1", 2.0, None),
        ("o2", None, "p1", None, None),
        ("o3", None, None, 3.0, None),
    ]


def test_row_count_is_items_or_one_per_kept_order(spark):
    orders, customers, items, products = _star(spark)
    sizes = items.groupBy("order_id").agg(F.count(F.lit(1)).alias("n"))
    kept = silver.keep_orders(orders).join(sizes, "order_id", "left")
    want = kept.agg(F.sum(F.greatest(F.coalesce("n", F.lit(0)), F.lit(1)))).first()[0]
    assert silver.build_silver(orders, customers, items, products).count() == want == 4


def test_empty_tables(spark):
    orders, customers, items, products = _star(spark)
    assert silver.build_silver(orders.limit(0), customers, items, products).count() == 0
    assert silver.build_silver(orders, customers.limit(0), items.limit(0), products.limit(0)).count() == 3


def test_quality_report(spark):
    quality = reports.silver_quality(silver.build_silver(*_star(spark))).first()
    assert quality.asDict() == {"total_rows": 4, "null_delivery_rows": 4, "excluded_rows": 0}


def test_samples(spark, rows):
    orders, customers, items, products = _star(spark)
    assert rows(reports.sample_orders(orders, n=2), "order_id") == [("o1",), ("o2",)]
    sample = reports.sample_sales(silver.build_silver(orders, customers, items, products), 3)
    assert sample.count() == 3 and sample.columns == list(reports.SILVER_COLUMNS)


def test_opt_in_cleaning(spark, rows):
    orders, customers, items, products = _star(spark)
    twice = [df.unionAll(df) for df in (orders, customers, items, products)]
    picked = ("order_id", "product_id", "price")
    once = rows(silver.build_silver(orders, customers, items, products), *picked)
    assert rows(silver.build_silver(*twice, drop_duplicates=True), *picked) == once
    assert silver.build_silver(*twice).count() > len(once)
    kept = silver.build_silver(orders, customers, items, products, required=["product_id"])
    assert rows(kept, *picked) == [r for r in once if r[1] is not None]


def test_delivery_of_another_type_is_filled(spark, rows):
    orders = spark.createDataFrame(
        [("1", "no date", datetime(2018, 1, 3)), ("2", None, datetime(2018, 1, 4))],
        "order_id string, order_delivered_customer_date string, order_estimated_delivery_date timestamp",
    ).withColumn("order_status", F.lit("x"))
    cleaned = silver.clean_orders(orders)
    assert rows(cleaned, "order_id", F.to_date("order_delivered_customer_date").cast("string")) == [("1", None), ("2", "2018-01-04")]


def test_deduplicated_items_meet_their_products_before_orders(spark, conf, rows):
    """Only items travel by product, not whole sales: the join with products lies below that with items."""
    conf({"spark.sql.autoBroadcastJoinThreshold": "-1"})
    orders = spark.createDataFrame(
        [("o1", "c1", "ok"), ("o1", "c1", "ok"), ("o2", "c9", "ok"), ("o3", None, "ok"), (None, "c1", "ok"), ("o4", "c1", "canceled")],
        "order_id string, customer_id string, order_status string",
    ).withColumns({c: F.lit(None).cast("timestamp") for c in silver.ORDER_TIMES})
    customers = spark.createDataFrame([("c1", "p1"), ("c1", "p2")], "customer_id string, customer_unique_id string")
    items = spark.createDataFrame(
        [("o1", "x1", 1), ("o1", "x1", 1), ("o1", "x2", 2), ("o1", None, 3), ("o3", "x9", 4), (None, "x1", 5), ("o4", "x1", 6)],
        "order_id string, product_id string, price int",
    )
    products = spark.createDataFrame([("x1", "toys"), ("x1", "toys"), ("x1", "more"), (None, "none")], "product_id string, kind string")
    got = silver.build_silver(orders, customers, items, products, drop_duplicates=True)
    single = [df.distinct() for df in (orders, customers, items, products)]
    want = silver.denormalize(silver.clean_orders(single[0]), *single[1:])
    assert got.columns == want.columns and rows(got) == rows(want) and got.count() == 12
    plan = got.select("kind", "price", "order_status")._jdf.queryExecution().executedPlan().toString()
    joins = [(line.index("SortMergeJoin"), line) for line in plan.split("\n") if "SortMergeJoin" in line]
    inner = min(depth for depth, line in joins if "Inner" in line)
    assert all(depth > inner for depth, line in joins if "[product_id" in line)
