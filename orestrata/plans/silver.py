"""Clean orders and join them with customers, items and products."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orestrata.functions.dates import as_timestamps
from orestrata.operators.dedup import drop_copies, drop_null_keys
from orestrata.operators.joins import left_fan_out, left_lookup

# The excluded status and the order columns that hold times.
CANCELED = "canceled"
ORDER_TIMES = (
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)


def keep_orders(orders: DataFrame, excluded: str = CANCELED, status: str = "order_status") -> DataFrame:
    """Orders of any other known status: one without a status is not kept either."""
    return orders.filter(F.col(status) != excluded)


def fill_delivery(
    orders: DataFrame,
    delivered: str = "order_delivered_customer_date",
    estimated: str = "order_estimated_delivery_date",
) -> DataFrame:
    """The estimated delivery date where no delivery is recorded.

    The dates are filled as they are, text before it is parsed: a delivery date that is no
    date stays one. Where only one of the columns is text, both are taken as text.
    """
    kinds = {orders.schema[c].dataType.typeName() for c in (delivered, estimated)}
    dates = [F.col(c).cast("string") if len(kinds) > 1 and "string" in kinds else F.col(c) for c in (delivered, estimated)]
    return orders.withColumn(delivered, F.coalesce(*dates))


def clean_orders(orders: DataFrame, excluded: str = CANCELED) -> DataFrame:
    """Kept orders with delivery filled and every time column a timestamp."""
    filled = fill_delivery(keep_orders(orders, excluded))
    return as_timestamps(filled, [c for c in ORDER_TIMES if c in filled.columns])


def denormalize(
    orders: DataFrame, customers: DataFrame, items: DataFrame, products: DataFrame, *, products_first: bool = False
) -> DataFrame:
    """One row per order and item, or one per order without items; all columns kept.

    Products come last: a small product table is then broadcast instead of travelling with
    the items, and rows without a product, or with a hot one, are on the side that adaptive
    execution splits.

    With `products_first` they are looked up for the items alone. For items that come in no
    order, as after `drop_copies`: what travels by product is then narrow, and the rows of an
    order stay together, in the written table as in aggregates over it.
    """
    keys = ["product_id", "order_id", "customer_id"]
    columns = [c for df in (orders, customers, items, products) for c in df.columns if c not in keys]
    people = left_lookup(orders, customers, "customer_id")
    if products_first:
        sales = left_fan_out(people, left_lookup(items, products, "product_id"), "order_id")
    else:
        sales = left_lookup(left_fan_out(people, items, "order_id"), products, "product_id")
    return sales.select(*keys, *columns)


def build_silver(
    orders: DataFrame,
    customers: DataFrame,
    items: DataFrame,
    products: DataFrame,
    excluded: str = CANCELED,
    *,
    drop_duplicates: bool = False,
    required: Sequence[str] = (),
) -> DataFrame:
    """The silver sales table from the four bronze tables.

    Off by default: keeping one of identical rows in each input, and dropping sales without
    a value in the `required` columns.
    """
    if drop_duplicates:
        orders, customers, items, products = map(drop_copies, (orders, customers, items, products))
    sales = denormalize(clean_orders(orders, excluded), customers, items, products, products_first=drop_duplicates)
    return drop_null_keys(sales, required) if required else sales
