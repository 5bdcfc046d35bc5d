"""Registered queries over the given tables, and the SQL each must agree with.

The tables stand in for the sales data: `orders` as orders (status F is the excluded one,
O is "delivered"), `customer` as customers (each its own person), `lineitem` as order
items (price = extended price, freight = price x tax) and `part` as products. An order is
delivered when its last item ships, and expected seven days after it was placed.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from decimal import Decimal
from pathlib import Path
from uuid import uuid4

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orestrata.functions.dates import as_timestamps
from orestrata.functions.rounding import rounded_average
from orestrata.operators import dedup
from orestrata.operators.joins import left_fan_out, left_lookup
from orestrata.operators.ntile import with_ntiles
from orestrata.operators.upsert import upsert, upsert_table
from orestrata.plans import incremental, reports, rfm, silver, stages
from orestrata.sources import files, paths, tables
from orestrata.sources.registry import only
from orestrata.sources.scratch import scratch_path, shared_folder

# The training-data operators are a subpackage that the rest works without, be it that the
# subpackage is missing or a library that it needs.
try:
    import corpus_pipeline
    from orestrata.llm import queries as llm
except ModuleNotFoundError:
    llm = None

EXCLUDED = "F"
PLACED = "O"
SMOKE = "/root/testdata/sf0.001"


# --- the tables in their roles -------------------------------------------------------


GIVEN = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
}


def _given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return tables.read_table(spark, f"{sf_dir}/{table}.parquet", GIVEN[table])


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _given(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
    )


def _dated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the delivery date (none without items) and the estimated one."""
    shipped = (
        _given(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("order_id"))
        .agg(F.max("l_shipdate").alias("order_delivered_customer_date"))
    )
    estimated = F.col("order_purchase_timestamp") + F.expr("INTERVAL 7 DAYS")
    return left_lookup(_orders(spark, sf_dir), shipped, "order_id").withColumn(
        "order_estimated_delivery_date", estimated
    )


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _given(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_custkey").alias("customer_unique_id"),
        F.col("c_mktsegment").alias("customer_market"),
    )


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    return _given(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        price.alias("price"),
        (price * F.col("l_tax").cast("decimal(4,2)")).alias("freight_value"),
    )


def _products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _given(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_brand").alias("product_brand")
    )


def _kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.keep_orders(_orders(spark, sf_dir), EXCLUDED)


def _sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per kept order."""
    return rfm.order_sales(_kept(spark, sf_dir), _customers(spark, sf_dir), _items(spark, sf_dir))


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rfm.rfm_base(_sales(spark, sf_dir), "amount")


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.build_silver(
        _dated_orders(spark, sf_dir),
        _customers(spark, sf_dir),
        _items(spark, sf_dir),
        _products(spark, sf_dir),
        EXCLUDED,
    )


def _shown(df: DataFrame) -> DataFrame:
    """Money as doubles and product ids as text, the types of the sales data."""
    types = {"price": "double", "freight_value": "double", "product_id": "string"}
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items()})


# --- scans, filters, joins -----------------------------------------------------------


def scan_columnar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir)


def scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders written as CSV and read back under their own schema."""
    orders = _given(spark, sf_dir, "orders")
    path = scratch_path(spark, "orders-csv")
    orders.write.csv(path, header=True)
    return files.read_csv(spark, path, schema=orders.schema)


def scan_csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with every type guessed; the guesses are then widened to the given types."""
    orders = _given(spark, sf_dir, "orders")
    path = scratch_path(spark, "orders-csv")
    orders.write.csv(path, header=True)
    guessed = files.read_csv(spark, path, infer=True)
    return guessed.select(*[F.col(f.name).cast(f.dataType) for f in orders.schema])


def ingest_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four raw datasets ingested to bronze; the rows found in each written table."""
    base, datasets = _raw_files(spark, sf_dir)
    stages.ingest(spark, f"{base}/raw", base, datasets)
    return reports.count_each({
        d.name: tables.read_table(spark, stages.layer_path(base, "bronze", d.name)) for d in datasets
    })


def ingest_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items ingested from a file in which the price of every seventh line is no number."""
    price = F.when(F.col("l_linenumber") == 7, "n/a").otherwise(F.col("l_extendedprice").cast("decimal(12,2)").cast("string"))
    items = _given(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("order_id"), price.alias("price"))
    base, datasets = scratch_path(spark, "layers"), only("order_items")
    items.write.csv(f"{base}/raw/{datasets[0].file}", header=True)
    counted = stages.ingest_counts(spark, f"{base}/raw", base, datasets)
    rows = [(name, c.rows_read, c.rows_written, c.unreadable) for name, c in counted.items()]
    return spark.createDataFrame(rows, "dataset string, rows_read bigint, rows_written bigint, unreadable bigint")


def ingest_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The values of that file, and prices of freight that are too long, as the rejects table has them."""
    price = F.when(F.col("l_linenumber") == 7, "n/a").otherwise(F.col("l_extendedprice").cast("decimal(12,2)").cast("string"))
    freight = F.when(F.col("l_linenumber") > 5, F.concat(F.lit("12345678901234567890123"), F.col("l_linenumber").cast("string"))).otherwise("1.5")
    items = _given(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("order_id"), price.alias("price"), freight.alias("freight_value"))
    base, datasets = scratch_path(spark, "layers"), only("order_items")
    items.write.csv(f"{base}/raw/{datasets[0].file}", header=True)
    stages.ingest_counts(spark, f"{base}/raw", base, datasets, rejects=True)
    return tables.read_table(spark, stages.layer_path(base, "rejects", "order_items")).select("line", "column_name", "text", "reason")


def run_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that fails in its last stage, as its table's name is taken, and is run again: the
    report, with the versions that were written of a bronze table and of silver, and the
    folders that the runs have left among the intermediate tables."""
    base, datasets = _raw_files(spark, sf_dir)
    database = f"run_{uuid4().hex}"
    tables.create_database(spark, database, f"{base}/catalog")
    spark.sql(f"CREATE TABLE {database}.{stages.GOLD_TABLE} (taken int) USING PARQUET")
    before = set(paths.children(spark, shared_folder(spark)))
    try:
        stages.run_all(spark, f"{base}/raw", base, datasets, database, excluded=EXCLUDED)
    except ValueError:
        spark.sql(f"DROP TABLE {database}.{stages.GOLD_TABLE}")
    stages.run_all(spark, f"{base}/raw", base, datasets, database, excluded=EXCLUDED)
    left = [name for name in paths.children(spark, shared_folder(spark)) if name not in before]
    written = {
        "bronze_writes": len(paths.versions(spark, stages.layer_path(base, "bronze", "orders"))),
        "silver_writes": len(paths.versions(spark, stages.layer_path(base, "silver", stages.SILVER_SALES))),
        "folders_left": len(left),
    }
    report = reports.segment_distribution(stages.gold_table(spark, base, database))
    return report.withColumns({name: F.lit(count) for name, count in written.items()})


def malformed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders ingested from CSV with every tenth delivery date no date, and cleaned; both with
    declared and with inferred types."""
    base, datasets = scratch_path(spark, "layers"), only("orders")
    orders = _dated_orders(spark, sf_dir).withColumns({
        c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("order_delivered_customer_date", "order_estimated_delivery_date")
    })
    bad = F.when(F.col("order_id") % 10 == 0, "no date").otherwise(F.col("order_delivered_customer_date"))
    orders.withColumn("order_delivered_customer_date", bad).write.csv(f"{base}/raw/{datasets[0].file}", header=True)

    def cleaned(infer: bool) -> DataFrame:
        layers = f"{base}/{infer}"
        stages.ingest(spark, f"{base}/raw", layers, datasets, infer=infer)
        kept = silver.clean_orders(tables.read_table(spark, stages.layer_path(layers, "bronze", "orders")), EXCLUDED)
        delivered = F.col("order_delivered_customer_date").cast("timestamp_ntz").alias("order_delivered_customer_date")
        return kept.select(F.lit(infer).alias("inferred"), F.col("order_id").cast("bigint").alias("order_id"), delivered)

    return cleaned(False).unionAll(cleaned(True))


def _raw_files(spark: SparkSession, sf_dir: str, *, twice: bool = False):
    """The four datasets as CSV files in a new folder, packed as raw text mostly is: (folder, datasets)."""
    base = scratch_path(spark, "layers")
    raw = {
        "orders": _dated_orders(spark, sf_dir),
        "customers": _customers(spark, sf_dir),
        "order_items": _items(spark, sf_dir).withColumn("freight_value", F.col("freight_value").cast("decimal(18,4)")),
        "products": _products(spark, sf_dir),
    }
    datasets = only(*raw)
    for dataset in datasets:
        if twice:
            raw[dataset.name] = raw[dataset.name].unionAll(raw[dataset.name])
        raw[dataset.name].write.csv(f"{base}/raw/{dataset.file}", header=True, compression="gzip")
    return base, datasets


def filter_not_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kept(spark, sf_dir)


def filter_equal_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.sample_orders(_orders(spark, sf_dir), PLACED)


def filter_is_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = left_fan_out(_orders(spark, sf_dir), _items(spark, sf_dir), "order_id")
    return reports.missing(joined, "product_id").select("order_id", "customer_id", "order_status")


def null_fill_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates as text, filled and then parsed, as they come from an untyped source."""
    names = ["order_delivered_customer_date", "order_estimated_delivery_date"]
    text = _dated_orders(spark, sf_dir).withColumns({
        c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in names
    })
    parsed = as_timestamps(silver.fill_delivery(text), names)
    return parsed.select("order_id", *[F.col(c).cast("timestamp_ntz").alias(c) for c in names])


def join_orders_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return left_lookup(_orders(spark, sf_dir), _customers(spark, sf_dir), "customer_id")


def join_orders_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(left_fan_out(_orders(spark, sf_dir), _items(spark, sf_dir), "order_id"))


def join_items_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products looked up for rows whose product may be NULL."""
    rows = left_fan_out(_orders(spark, sf_dir).select("order_id"), _items(spark, sf_dir), "order_id")
    return _shown(left_lookup(rows, _products(spark, sf_dir), "product_id"))


def silver_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_silver(spark, sf_dir))


def silver_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.sample_sales(_silver(spark, sf_dir), 10)


# --- aggregates, scores, segments ----------------------------------------------------


def agg_global_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rfm.reference_date(_kept(spark, sf_dir))


def agg_count_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.count_rows(_orders(spark, sf_dir))


def agg_rfm_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _base(spark, sf_dir)


def agg_rfm_from_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics from the denormalized table instead of order totals."""
    return rfm.rfm_base(_silver(spark, sf_dir))


def rfm_null_freight(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics where the freight of some products is unknown: such an item counts for nothing."""
    freight = F.when(F.col("product_id") % 5 != 0, F.col("freight_value"))
    items = _items(spark, sf_dir).withColumn("freight_value", freight)
    sales = rfm.order_sales(_kept(spark, sf_dir), _customers(spark, sf_dir), items)
    return rfm.rfm_base(sales, "amount")


def _one_score(score: str, metric: str) -> Callable[[SparkSession, str], DataFrame]:
    """One score, with bounds so low that the search for bucket ends has to narrow."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        base = _base(spark, sf_dir).select("customer_unique_id", metric)
        ordering = {score: rfm.score_orderings()[score]}
        return with_ntiles(base, 4, ordering, sort_rows=400, sample_rows=400)

    return query


def rfm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rfm.rfm_scores(_base(spark, sf_dir)).select(
        "customer_unique_id", "r_score", "f_score", "m_score", "rfm_score_string"
    )


def rfm_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rfm.rfm_segments(_sales(spark, sf_dir), "amount")


def rfm_partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments written partitioned, found by the catalog from their path, read back."""
    path = scratch_path(spark, "segments")
    tables.write_table(rfm_segments(spark, sf_dir), path, ["rfm_segment"])
    return tables.table_or_register(spark, f"default.segments_{uuid4().hex}", path)


def segment_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.segment_distribution(rfm_segments(spark, sf_dir))


def sql_segment_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL text over the registered segment table, by ordinals."""
    path, name = scratch_path(spark, "segments"), f"default.segments_{uuid4().hex}"
    tables.write_table(rfm_segments(spark, sf_dir), path, ["rfm_segment"])
    tables.register_table(spark, name, path)
    return spark.sql(f"""
        SELECT rfm_segment, count(*) AS customer_count, max(recency) AS max_recency
        FROM {name} GROUP BY 1 ORDER BY 2 DESC, 1""")


def sql_order_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL text over a registered table: status filter, projection, limit."""
    name = f"default.orders_{uuid4().hex}"
    tables.register_table(spark, name, f"{sf_dir}/orders.parquet")
    return spark.sql(f"""
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_purchase_timestamp
        FROM {name} WHERE o_orderstatus = '{PLACED}' ORDER BY order_id LIMIT 5""")


def top_segment_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_customers(rfm_segments(spark, sf_dir))


def silver_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.silver_quality(_silver(spark, sf_dir), excluded=EXCLUDED)


def layered_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw CSV files through every stage, reported from the registered gold table."""
    base, datasets = _raw_files(spark, sf_dir)
    database = f"run_{uuid4().hex}"
    tables.create_database(spark, database, f"{base}/catalog")
    stages.run_all(spark, f"{base}/raw", base, datasets, database, excluded=EXCLUDED)
    return reports.segment_distribution(stages.gold_table(spark, base, database))


def layered_run_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with every raw row twice, without duplicates and without sales of no product."""
    base, datasets = _raw_files(spark, sf_dir, twice=True)
    database = f"run_{uuid4().hex}"
    tables.create_database(spark, database, f"{base}/catalog")
    cleaning = {"drop_duplicates": True, "required": ["product_id"]}
    stages.run_all(spark, f"{base}/raw", base, datasets, database, excluded=EXCLUDED, **cleaning)
    return reports.segment_distribution(stages.gold_table(spark, base, database))


# --- opt-in cleaning, upsert, catalog ------------------------------------------------


def dedup_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _given(spark, sf_dir, "lineitem")
    return dedup.drop_copies(items.unionAll(items))


def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order with a later version in which its status is open and its price doubled."""
    orders = _given(spark, sf_dir, "orders").drop("o_orderpriority").withColumn("version", F.lit(1))
    changed = orders.withColumns({
        "o_orderstatus": F.lit("X"), "o_totalprice": F.col("o_totalprice") * 2, "version": F.lit(2),
    }).join(
        _kept(spark, sf_dir).select(F.col("order_id").alias("o_orderkey")), "o_orderkey", "left_semi"
    )
    return dedup.latest_per_key(orders.unionByName(changed), ["o_orderkey"], [F.desc("version")])


def drop_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = left_fan_out(_orders(spark, sf_dir), _items(spark, sf_dir), "order_id")
    return _shown(dedup.drop_null_keys(joined, ["order_id", "product_id"]))


def upsert_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Excluded orders come back under a new status, and each customer's key space grows by
    one new order per priority-1 order."""
    orders = _given(spark, sf_dir, "orders")
    changed = orders.filter(F.col("o_orderstatus") == EXCLUDED).withColumn("o_orderstatus", F.lit("R"))
    added = orders.filter(F.col("o_orderpriority") == "1-URGENT").withColumn(
        "o_orderkey", -F.col("o_orderkey") - 1
    )
    return upsert(orders, changed.unionByName(added), ["o_orderkey"])


def upsert_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders stored by status, upserted in place: urgent orders move to another status, which
    empties no place, those of one status all leave it, new ones arrive. One status is not touched."""
    path = scratch_path(spark, "orders")
    orders = _given(spark, sf_dir, "orders")
    tables.publish(orders, path, ["o_orderstatus"])
    urgent = (F.col("o_orderstatus") == EXCLUDED) & (F.col("o_orderpriority") == "1-URGENT")
    moved = orders.filter(urgent).withColumn("o_orderstatus", F.lit("R"))
    left = orders.filter("o_orderstatus = 'P'").withColumns({"o_orderstatus": F.lit("Q"), "o_totalprice": F.col("o_totalprice") * 2})
    added = orders.filter("o_orderpriority = '5-LOW' AND o_orderstatus = 'F'").withColumn("o_orderkey", -F.col("o_orderkey") - 1)
    upsert_table(spark, path, moved.unionAll(left).unionAll(added), ["o_orderkey"], ["o_orderstatus"])
    return tables.read_table(spark, path)


def silver_after_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver table by month, built from most of the rows of each dataset and brought up to
    date twice, as the rest arrives."""
    base = scratch_path(spark, "layers")
    kinds = {
        "orders": (_dated_orders(spark, sf_dir), "order_id"),
        "customers": (_customers(spark, sf_dir), "customer_id"),
        "order_items": (_items(spark, sf_dir), "product_id"),
        "products": (_products(spark, sf_dir), "product_id"),
    }
    for name, (rows, key) in kinds.items():
        tables.publish(rows.filter(F.col(key) % 50 > 1), stages.layer_path(base, "bronze", name))
    incremental.update_silver(spark, base, EXCLUDED)
    for late in ({"orders": 0, "order_items": 1}, {"customers": 0, "products": 1, "order_items": 0, "orders": 1}):
        for name, rest in late.items():
            rows, key = kinds[name]
            both = name in ("customers", "products")
            incremental.append(rows.filter(F.col(key) % 50 <= 1 if both else F.col(key) % 50 == rest), base, name)
        incremental.update_silver(spark, base, EXCLUDED)
    return _shown(incremental.sales_by_month(spark, base).drop(incremental.MONTH))


def catalog_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given tables registered in a new database, listed there, described and counted."""
    database = f"given_{uuid4().hex}"
    tables.create_database(spark, database, scratch_path(spark, "catalog"))
    tables.register_all(spark, {t: f"{sf_dir}/{t}.parquet" for t in GIVEN}, database)
    listed = tables.tables(spark, database, "*").collect()
    return reports.table_check(spark, [f"{database}.{row.tableName}" for row in listed])


def column_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of the given tables as the catalog describes them, and their values counted."""
    database = f"given_{uuid4().hex}"
    tables.create_database(spark, database, scratch_path(spark, "catalog"))
    names = tables.register_all(spark, {t: f"{sf_dir}/{t}.parquet" for t in GIVEN}, database)
    return reports.column_check(spark, names).withColumn("table_name", F.substring_index("table_name", ".", -1))


def database_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Databases found by listing, one made for each given table, and their rows."""
    run = uuid4().hex
    for table in GIVEN:
        tables.create_database(spark, f"{table}_{run}", scratch_path(spark, "catalog"))
        tables.register_table(spark, f"{table}_{run}.given", f"{sf_dir}/{table}.parquet")
    listed = [row.namespace for row in tables.databases(spark).collect() if row.namespace.endswith(run)]
    return reports.count_each({name.removesuffix(f"_{run}"): spark.table(f"{name}.given") for name in listed})


def partitions_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A known partitioned table, overwritten with another label and resolved again."""
    path, name = scratch_path(spark, "customers"), f"default.customers_{uuid4().hex}"
    even = F.col("customer_id") % 2 == 0
    for label, kept in (("a", even), ("b", ~even)):
        tables.write_table(_customers(spark, sf_dir).filter(kept).withColumn("label", F.lit(label)), path, ["label"])
        found = tables.table_or_register(spark, name, path)
    return found


def table_moved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A known table resolved for a second folder: the rows there."""
    name = f"default.orders_{uuid4().hex}"
    for status in (EXCLUDED, PLACED):
        path = scratch_path(spark, "orders")
        tables.write_table(_orders(spark, sf_dir).filter(F.col("order_status") == status), path)
        found = tables.table_or_register(spark, name, path)
    return found


def table_swapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that a write replaces after another write has failed half-way: its rows by name
    and by path after the failure, and by name after the swap."""
    path, name = scratch_path(spark, "orders"), f"default.orders_{uuid4().hex}"
    orders = _given(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    tables.publish(orders, path, name=name)
    last = orders.agg(F.max("o_orderkey")).first()[0]
    breaks = F.when(F.col("o_orderkey") == last, F.raise_error("fails at the last order").cast("double"))
    try:
        tables.publish(orders.withColumn("o_totalprice", F.coalesce(breaks, F.lit(0.0))), path, name=name)
    except PySparkException as error:
        if "fails at the last order" not in str(error):
            raise
    failed = spark.table(name).withColumn("seen", F.lit("failed, by name"))
    by_path = tables.read_table(spark, path).withColumn("seen", F.lit("failed, by path"))
    tables.publish(orders.withColumn("o_totalprice", F.col("o_totalprice") * 2), path, name=name)
    swapped = spark.table(name).withColumn("seen", F.lit("swapped"))
    return failed.unionAll(by_path).unionAll(swapped)


def average_near_half_cent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Averages that are half a cent by construction, on 1, 7 and 200 partitions: each order's
    price, and what it lacks to a total that ends so."""
    price = F.col("o_totalprice").cast("decimal(12,2)")
    rest = (F.lit(Decimal("300.01")) + F.col("o_custkey") % 7 - price).cast("double")
    orders = _given(spark, sf_dir, "orders")
    group = (F.col("o_custkey") % 7).alias("customer_group")
    values = orders.select(group, "o_totalprice").unionAll(orders.select(group, rest))

    def averages(partitions: int) -> DataFrame:
        average = rounded_average("o_totalprice").alias("average")
        return values.repartition(partitions).groupBy("customer_group").agg(average).withColumn("partitions", F.lit(partitions))

    return averages(1).unionAll(averages(7)).unionAll(averages(200))


def entry(spark: SparkSession) -> DataFrame:
    """Customer segments at the smallest scale."""
    return rfm_segments(spark, SMOKE)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every registered query: (spark, folder of the tables) -> DataFrame."""
    added = {**llm.queries(), "pipeline": corpus_pipeline.run} if llm else {}
    return {
        "scan_columnar": scan_columnar,
        "scan_csv": scan_csv,
        "scan_csv_inferred": scan_csv_inferred,
        "ingest_audit": ingest_audit,
        "filter_not_equal": filter_not_equal,
        "filter_equal_sample": filter_equal_sample,
        "filter_is_null": filter_is_null,
        "null_fill_dates": null_fill_dates,
        "join_orders_customers": join_orders_customers,
        "join_orders_items": join_orders_items,
        "join_items_products": join_items_products,
        "silver_sales": silver_sales,
        "silver_sample": silver_sample,
        "agg_global_max": agg_global_max,
        "agg_count_star": agg_count_star,
        "agg_rfm_base": agg_rfm_base,
        "agg_rfm_from_silver": agg_rfm_from_silver,
        "ntile_recency": _one_score("r_score", "recency"),
        "ntile_frequency": _one_score("f_score", "frequency"),
        "ntile_monetary": _one_score("m_score", "monetary"),
        "rfm_scores": rfm_scores,
        "rfm_segments": rfm_segments,
        "rfm_partitioned_roundtrip": rfm_partitioned_roundtrip,
        "segment_distribution": segment_distribution,
        "sql_segment_report": sql_segment_report,
        "sql_order_sample": sql_order_sample,
        "top_segment_customers": top_segment_customers,
        "silver_quality": silver_quality,
        "layered_run": layered_run,
        "dedup_rows": dedup_rows,
        "dedup_latest": dedup_latest,
        "drop_null_keys": drop_null_keys,
        "upsert_orders": upsert_orders,
        "catalog_listing": catalog_listing,
        "ingest_losses": ingest_losses,
        "malformed_dates": malformed_dates,
        "rfm_null_freight": rfm_null_freight,
        "layered_run_cleaned": layered_run_cleaned,
        "column_listing": column_listing,
        "database_listing": database_listing,
        "partitions_replaced": partitions_replaced,
        "table_moved": table_moved,
        "table_swapped": table_swapped,
        "average_near_half_cent": average_near_half_cent,
        "upsert_partitions": upsert_partitions,
        "silver_after_arrivals": silver_after_arrivals,
        "ingest_rejects": ingest_rejects,
        "run_resumed": run_resumed,
        **added,
    }


# --- the SQL to agree with -----------------------------------------------------------

_ORDERS = """
orders_role AS (
    SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS order_status,
           o_orderdate AS order_purchase_timestamp
    FROM orders
)"""

_DATED = f"""{_ORDERS},
dated AS (
    SELECT o.*, s.shipped AS order_delivered_customer_date,
           o.order_purchase_timestamp + INTERVAL 7 DAY AS order_estimated_delivery_date
    FROM orders_role o
    LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS shipped FROM lineitem GROUP BY l_orderkey) s
      ON s.l_orderkey = o.order_id
)"""

_ITEMS = """
items AS (
    SELECT l_orderkey AS order_id, l_partkey AS product_id,
           CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
           CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)) AS freight_value
    FROM lineitem
)"""


def _base_sql(person: str = "c.c_custkey", items: str = _ITEMS, join: str = "LEFT JOIN") -> str:
    return f"""{_ORDERS}, {items},
sales AS (
    SELECT {person} AS customer_unique_id, o.order_id, o.order_purchase_timestamp, i.price, i.freight_value
    FROM orders_role o
    LEFT JOIN customer c ON c.c_custkey = o.customer_id
    {join} items i ON i.order_id = o.order_id
    WHERE o.order_status <> 'F'
),
base AS (
    SELECT customer_unique_id,
           max(order_purchase_timestamp) AS last_purchase_date,
           count(DISTINCT order_id) AS frequency,
           CAST(sum(price + freight_value) AS DOUBLE) AS monetary,
           CAST(date_diff('day', CAST(max(order_purchase_timestamp) AS DATE),
                CAST((SELECT max(order_purchase_timestamp) + INTERVAL 1 DAY FROM sales) AS DATE)) AS INTEGER)
               AS recency
    FROM sales GROUP BY customer_unique_id
)"""


_R = "CAST(ntile(4) OVER (ORDER BY recency DESC NULLS LAST, customer_unique_id NULLS FIRST) AS INTEGER) AS r_score"
_F = "CAST(ntile(4) OVER (ORDER BY frequency NULLS FIRST, customer_unique_id NULLS FIRST) AS INTEGER) AS f_score"
_M = "CAST(ntile(4) OVER (ORDER BY monetary NULLS FIRST, customer_unique_id NULLS FIRST) AS INTEGER) AS m_score"


def _segments_sql(*args: str) -> str:
    return f"""{_base_sql(*args)},
scores AS (SELECT *, {_R}, {_F}, {_M} FROM base),
strings AS (
    SELECT *, CAST(r_score AS VARCHAR) || CAST(f_score AS VARCHAR) || CAST(m_score AS VARCHAR) AS rfm_score_string
    FROM scores
),
segments AS (
    SELECT *, CASE WHEN rfm_score_string = '444' THEN 'Champions/VIP'
                   WHEN r_score = 4 THEN 'Recent Customers'
                   WHEN f_score = 4 THEN 'Loyal Customers'
                   WHEN m_score = 4 THEN 'Big Spenders'
                   WHEN r_score = 1 THEN 'Lost Customers'
                   WHEN r_score = 2 THEN 'At Risk'
                   ELSE 'General Customers' END AS rfm_segment
    FROM strings
)"""


def _average(column: str) -> str:
    return f"round(avg({column}), 2) AS avg_{column}"


def _distribution_sql(*args: str) -> str:
    return f"""WITH {_segments_sql(*args)}
    SELECT rfm_segment, count(*) AS customer_count, {_average("monetary")}, {_average("recency")},
           {_average("frequency")}
    FROM segments GROUP BY rfm_segment ORDER BY customer_count DESC, rfm_segment"""


_SILVER = f"""{_DATED}, {_ITEMS},
silver AS (
    SELECT CAST(i.product_id AS VARCHAR) AS product_id, o.order_id, o.customer_id, o.order_status, o.order_purchase_timestamp,
           coalesce(o.order_delivered_customer_date, o.order_estimated_delivery_date)
               AS order_delivered_customer_date,
           o.order_estimated_delivery_date,
           c.c_custkey AS customer_unique_id, c.c_mktsegment AS customer_market,
           CAST(i.price AS DOUBLE) AS price, CAST(i.freight_value AS DOUBLE) AS freight_value,
           p.p_brand AS product_brand
    FROM dated o
    LEFT JOIN customer c ON c.c_custkey = o.customer_id
    LEFT JOIN items i ON i.order_id = o.order_id
    LEFT JOIN part p ON p.p_partkey = i.product_id
    WHERE o.order_status <> 'F'
)"""

# Without duplicates, and with the freight of some products unknown.
_DISTINCT_ITEMS = _ITEMS.replace("SELECT", "SELECT DISTINCT")
_NULL_FREIGHT = """
items AS (
    SELECT l_orderkey AS order_id, CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
           CASE WHEN l_partkey % 5 <> 0
                THEN CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)) END AS freight_value
    FROM lineitem
)"""


def _columns_sql() -> str:
    parts = [
        f"SELECT '{table}' AS table_name, {position} AS position, '{column.split()[0]}' AS column_name, "
        f"'{column.split()[1]}' AS data_type, count({column.split()[0]}) AS value_count FROM {table}"
        for table, schema in GIVEN.items()
        for position, column in enumerate(schema.split(", "))
    ]
    return " UNION ALL ".join(parts)


_ITEM_COLUMNS = """CAST(i.product_id AS VARCHAR) AS product_id,
           CAST(i.price AS DOUBLE) AS price, CAST(i.freight_value AS DOUBLE) AS freight_value"""


def oracle_sql() -> dict[str, str]:
    """The SQL for each query that SQL can express, over the same tables."""
    return {
        **(llm.oracle_sql() if llm else {}),
        "scan_columnar": f"WITH {_ORDERS} SELECT * FROM orders_role",
        "scan_csv": "SELECT * FROM orders",
        "scan_csv_inferred": "SELECT * FROM orders",
        "ingest_audit": """
            SELECT 'orders' AS dataset, count(*) AS row_count FROM orders
            UNION ALL SELECT 'order_items', count(*) FROM lineitem
            UNION ALL SELECT 'products', count(*) FROM part
            UNION ALL SELECT 'customers', count(*) FROM customer""",
        "filter_not_equal": f"WITH {_ORDERS} SELECT * FROM orders_role WHERE order_status <> 'F'",
        "filter_equal_sample": f"""WITH {_ORDERS}
            SELECT * FROM orders_role WHERE order_status = 'O' ORDER BY order_id LIMIT 5""",
        "filter_is_null": f"""WITH {_ORDERS}
            SELECT o.order_id, o.customer_id, o.order_status
            FROM orders_role o LEFT JOIN lineitem l ON l.l_orderkey = o.order_id
            WHERE l.l_partkey IS NULL""",
        "null_fill_dates": f"""WITH {_DATED}
            SELECT order_id,
                   coalesce(order_delivered_customer_date, order_estimated_delivery_date)
                       AS order_delivered_customer_date,
                   order_estimated_delivery_date
            FROM dated""",
        "join_orders_customers": f"""WITH {_ORDERS}
            SELECT o.*, c.c_custkey AS customer_unique_id, c.c_mktsegment AS customer_market
            FROM orders_role o LEFT JOIN customer c ON c.c_custkey = o.customer_id""",
        "join_orders_items": f"""WITH {_ORDERS}, {_ITEMS}
            SELECT o.*, {_ITEM_COLUMNS}
            FROM orders_role o LEFT JOIN items i ON i.order_id = o.order_id""",
        "join_items_products": f"""WITH {_ORDERS}, {_ITEMS}
            SELECT o.order_id, {_ITEM_COLUMNS}, p.p_brand AS product_brand
            FROM orders_role o
            LEFT JOIN items i ON i.order_id = o.order_id
            LEFT JOIN part p ON p.p_partkey = i.product_id""",
        "silver_sales": f"WITH {_SILVER} SELECT * FROM silver",
        "silver_sample": f"""WITH {_SILVER}
            SELECT order_id, customer_id, order_status, order_purchase_timestamp, order_delivered_customer_date
            FROM silver ORDER BY order_id LIMIT 10""",
        "agg_global_max": """
            SELECT max(o_orderdate) + INTERVAL 1 DAY AS reference_date FROM orders WHERE o_orderstatus <> 'F'""",
        "agg_count_star": "SELECT count(*) AS order_count FROM orders",
        "agg_rfm_base": f"WITH {_base_sql()} SELECT * FROM base",
        "agg_rfm_from_silver": f"WITH {_base_sql()} SELECT * FROM base",
        "ntile_recency": f"WITH {_base_sql()} SELECT customer_unique_id, recency, {_R} FROM base",
        "ntile_frequency": f"WITH {_base_sql()} SELECT customer_unique_id, frequency, {_F} FROM base",
        "ntile_monetary": f"WITH {_base_sql()} SELECT customer_unique_id, monetary, {_M} FROM base",
        "rfm_scores": f"""WITH {_segments_sql()}
            SELECT customer_unique_id, r_score, f_score, m_score, rfm_score_string FROM segments""",
        "rfm_segments": f"WITH {_segments_sql()} SELECT * FROM segments",
        "rfm_partitioned_roundtrip": f"WITH {_segments_sql()} SELECT * FROM segments",
        "segment_distribution": _distribution_sql(),
        "sql_segment_report": f"""WITH {_segments_sql()}
            SELECT rfm_segment, count(*) AS customer_count, max(recency) AS max_recency
            FROM segments GROUP BY rfm_segment ORDER BY customer_count DESC, rfm_segment""",
        "sql_order_sample": """
            SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_purchase_timestamp
            FROM orders WHERE o_orderstatus = 'O' ORDER BY order_id LIMIT 5""",
        "top_segment_customers": f"""WITH {_segments_sql()}
            SELECT customer_unique_id, frequency, monetary, recency, rfm_segment
            FROM segments WHERE rfm_segment = 'Champions/VIP'
            ORDER BY monetary DESC NULLS LAST, customer_unique_id LIMIT 10""",
        "silver_quality": f"""WITH {_SILVER}
            SELECT count(*) AS total_rows,
                   count(*) FILTER (WHERE order_delivered_customer_date IS NULL) AS null_delivery_rows,
                   count(*) FILTER (WHERE order_status = 'F') AS excluded_rows
            FROM silver""",
        # Ids read from raw files are text, and break ties as text.
        "layered_run": _distribution_sql("CAST(c.c_custkey AS VARCHAR)"),
        "dedup_rows": "SELECT * FROM lineitem UNION SELECT * FROM lineitem",
        "dedup_latest": """
            SELECT o_orderkey, o_custkey,
                   CASE WHEN o_orderstatus <> 'F' THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
                   CASE WHEN o_orderstatus <> 'F' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
                   o_orderdate,
                   CAST(CASE WHEN o_orderstatus <> 'F' THEN 2 ELSE 1 END AS INTEGER) AS version
            FROM orders""",
        "drop_null_keys": f"""WITH {_ORDERS}, {_ITEMS}
            SELECT o.*, {_ITEM_COLUMNS} FROM orders_role o JOIN items i ON i.order_id = o.order_id
            WHERE i.product_id IS NOT NULL""",
        "upsert_orders": """
            SELECT o_orderkey, o_custkey,
                   CASE WHEN o_orderstatus = 'F' THEN 'R' ELSE o_orderstatus END AS o_orderstatus,
                   o_totalprice, o_orderdate, o_orderpriority
            FROM orders
            UNION ALL
            SELECT -o_orderkey - 1, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
            FROM orders WHERE o_orderpriority = '1-URGENT'""",
        "catalog_listing": """
            SELECT 'orders' AS table_name,
                   'o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority' AS column_names,
                   count(*) AS row_count FROM orders
            UNION ALL SELECT 'customer', 'c_custkey,c_name,c_nationkey,c_acctbal,c_mktsegment', count(*)
            FROM customer
            UNION ALL SELECT 'lineitem', 'l_orderkey,l_partkey,l_suppkey,l_linenumber,l_quantity,'
                || 'l_extendedprice,l_discount,l_tax,l_returnflag,l_linestatus,l_shipdate', count(*) FROM lineitem
            UNION ALL SELECT 'part', 'p_partkey,p_name,p_brand,p_type,p_size,p_retailprice', count(*) FROM part""",
        "ingest_losses": """
            SELECT 'order_items' AS dataset, count(*) AS rows_read, count(*) AS rows_written,
                   count(*) FILTER (WHERE l_linenumber = 7) AS unreadable FROM lineitem""",
        "malformed_dates": f"""WITH {_DATED}
            SELECT inferred, order_id,
                   CASE WHEN order_id % 10 <> 0 THEN coalesce(order_delivered_customer_date, order_estimated_delivery_date) END
                       AS order_delivered_customer_date
            FROM dated CROSS JOIN (VALUES (false), (true)) AS t(inferred) WHERE order_status <> 'F'""",
        "rfm_null_freight": f"WITH {_base_sql('c.c_custkey', _NULL_FREIGHT)} SELECT * FROM base",
        "layered_run_cleaned": _distribution_sql("CAST(c.c_custkey AS VARCHAR)", _DISTINCT_ITEMS, "JOIN"),
        "column_listing": _columns_sql(),
        "database_listing": """
            SELECT 'orders' AS dataset, count(*) AS row_count FROM orders
            UNION ALL SELECT 'customer', count(*) FROM customer
            UNION ALL SELECT 'lineitem', count(*) FROM lineitem
            UNION ALL SELECT 'part', count(*) FROM part""",
        "partitions_replaced": """
            SELECT c_custkey AS customer_id, c_custkey AS customer_unique_id, c_mktsegment AS customer_market, 'b' AS label
            FROM customer WHERE c_custkey % 2 <> 0""",
        "table_moved": f"WITH {_ORDERS} SELECT * FROM orders_role WHERE order_status = 'O'",
        "table_swapped": """
            SELECT o_orderkey, CASE WHEN seen = 'swapped' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice, seen
            FROM orders CROSS JOIN (VALUES ('failed, by name'), ('failed, by path'), ('swapped')) AS t(seen)""",
        "upsert_partitions": """
            SELECT o_orderkey, o_custkey,
                   CASE WHEN o_orderstatus = 'P' THEN 'Q' WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN 'R'
                        ELSE o_orderstatus END AS o_orderstatus,
                   CASE WHEN o_orderstatus = 'P' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice, o_orderdate, o_orderpriority
            FROM orders
            UNION ALL
            SELECT -o_orderkey - 1, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
            FROM orders WHERE o_orderpriority = '5-LOW' AND o_orderstatus = 'F'""",
        "silver_after_arrivals": f"WITH {_SILVER} SELECT * FROM silver",
        "ingest_rejects": """
            WITH items AS (
                SELECT l_orderkey, CASE WHEN l_linenumber = 7 THEN 'n/a' ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) END AS price,
                       CASE WHEN l_linenumber > 5 THEN '12345678901234567890123' || l_linenumber ELSE '1.5' END AS freight, l_linenumber
                FROM lineitem
            ), lines AS (SELECT *, l_orderkey || ',' || price || ',' || freight AS line FROM items)
            SELECT line, 'price' AS column_name, price AS text, 'not a decimal(20,4)' AS reason FROM lines WHERE l_linenumber = 7
            UNION ALL SELECT line, 'freight_value', freight, 'not a decimal(20,4)' FROM lines WHERE l_linenumber > 5""",
        "run_resumed": f"""
            SELECT *, CAST(1 AS INTEGER) AS bronze_writes, CAST(1 AS INTEGER) AS silver_writes, CAST(0 AS INTEGER) AS folders_left
            FROM ({_distribution_sql("CAST(c.c_custkey AS VARCHAR)")})""",
        "average_near_half_cent": """
            WITH prices AS (
                SELECT o_custkey % 7 AS customer_group, CAST(o_totalprice AS DECIMAL(12,2)) AS price FROM orders
            ), cents AS (
                SELECT customer_group, 2 * count(*) AS n,
                       CAST(sum(price * 100) + sum((300.01 + customer_group - price) * 100) AS HUGEINT) AS total
                FROM prices GROUP BY customer_group
            )
            SELECT customer_group, CAST((2 * total + n) // (2 * n) AS DOUBLE) / 100 AS average, CAST(partitions AS INTEGER) AS partitions
            FROM cents CROSS JOIN (VALUES (1), (7), (200)) AS t(partitions)""",
    }
