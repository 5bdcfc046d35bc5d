"""Reports and checks over the layers. Each returns a DataFrame for the caller to show."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orestrata.functions.rounding import rounded_average
from orestrata.plans.rfm import PERSON
from orestrata.plans.silver import CANCELED
from orestrata.sources import tables

# The status, the columns and the segment the standard reports look at.
DELIVERED = "delivered"
ORDER_COLUMNS = ("order_id", "customer_id", "order_status", "order_purchase_timestamp")
SILVER_COLUMNS = (*ORDER_COLUMNS, "order_delivered_customer_date")
TOP_SEGMENT = "Champions/VIP"


def segment_distribution(
    segments: DataFrame, metrics: Sequence[str] = ("monetary", "recency", "frequency")
) -> DataFrame:
    """Customers and average metrics per segment, largest segment first."""
    averages = [rounded_average(metric).alias(f"avg_{metric}") for metric in metrics]
    return (
        segments.groupBy("rfm_segment")
        .agg(F.count(F.lit(1)).alias("customer_count"), *averages)
        .orderBy(F.desc("customer_count"), "rfm_segment")
    )


def top_customers(
    segments: DataFrame, segment: str = TOP_SEGMENT, n: int = 10, person: str = PERSON
) -> DataFrame:
    """The `n` biggest spenders of one segment."""
    return (
        segments.filter(F.col("rfm_segment") == segment)
        .select(person, "frequency", "monetary", "recency", "rfm_segment")
        .orderBy(F.desc_nulls_last("monetary"), F.asc_nulls_last(person))
        .limit(n)
    )


def sample_orders(
    orders: DataFrame,
    status: str = DELIVERED,
    n: int = 5,
    columns: Sequence[str] = ORDER_COLUMNS,
    order_by: Sequence[str] = ("order_id",),
) -> DataFrame:
    """`n` orders of one status, the first by key so that the sample is repeatable."""
    return orders.filter(F.col("order_status") == status).select(*columns).orderBy(*order_by).limit(n)


def sample_sales(
    silver: DataFrame,
    n: int = 10,
    columns: Sequence[str] = SILVER_COLUMNS,
    order_by: Sequence[str] = ("order_id",),
) -> DataFrame:
    """The first `n` silver rows by key."""
    return silver.select(*columns).orderBy(*order_by).limit(n)


def missing(df: DataFrame, column: str) -> DataFrame:
    """Rows without a value in `column`."""
    return df.filter(F.col(column).isNull())


def silver_quality(
    silver: DataFrame,
    delivered: str = "order_delivered_customer_date",
    status: str = "order_status",
    excluded: str = CANCELED,
) -> DataFrame:
    """One row: all rows, rows without a delivery date, rows that should be excluded."""
    return silver.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col(delivered).isNull()).alias("null_delivery_rows"),
        F.count_if(F.col(status) == excluded).alias("excluded_rows"),
    )


def count_rows(df: DataFrame, name: str = "order_count") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def count_each(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of each table, counted in one job: dataset, row_count."""
    counts = [
        count_rows(df, "row_count").select(F.lit(name).alias("dataset"), "row_count")
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def table_check(spark: SparkSession, names: Iterable[str]) -> DataFrame:
    """Rows and columns of each catalog table: table_name, column_names, row_count."""
    frames = {name: spark.table(name) for name in names}
    parts = [
        count_rows(df, "row_count").select(
            F.lit(name.split(".")[-1]).alias("table_name"),
            F.lit(",".join(df.columns)).alias("column_names"),
            "row_count",
        )
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionAll, parts)


def column_check(spark: SparkSession, names: Iterable[str]) -> DataFrame:
    """Every column of each catalog table with its type and its number of values:
    table_name, position, column_name, data_type, value_count."""
    names = list(names)

    def counted(name: str) -> DataFrame:
        df = spark.table(name)
        counts = df.agg(*[F.count(df[c]).alias(c) for c in df.columns])
        values = counts.unpivot([], [counts[c] for c in df.columns], "column_name", "value_count")
        return values.select(F.lit(name).alias("table_name"), "column_name", "value_count")

    values = reduce(DataFrame.unionAll, map(counted, names))
    return tables.describe(spark, names).join(values, ["table_name", "column_name"])
