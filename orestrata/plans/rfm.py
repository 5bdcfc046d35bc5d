"""Recency, frequency and monetary value per customer, quartile scores and segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orestrata.functions.dates import days_until
from orestrata.functions.segments import score_string, segment
from orestrata.operators.joins import left_lookup
from orestrata.operators.ntile import with_ntiles

PERSON = "customer_unique_id"
# What a sale is worth, as a SQL expression over its columns.
AMOUNT = "price + freight_value"


def order_sales(
    orders: DataFrame, customers: DataFrame, items: DataFrame, amount: str = AMOUNT
) -> DataFrame:
    """One row per kept order: person, order, purchase time, `amount`.

    Gives `rfm_base` the same result as the denormalized table where a product has one
    row, at a fraction of the shuffle: items collapse to one row per order before they
    move, so neither the fan-out nor a giant order is ever shuffled.
    """
    totals = items.groupBy("order_id").agg(F.sum(F.expr(amount)).alias("amount"))
    slim = orders.select("order_id", "customer_id", "order_purchase_timestamp")
    people = customers.select("customer_id", PERSON)
    sales = left_lookup(left_lookup(slim, totals, "order_id"), people, "customer_id")
    return sales.select(PERSON, "order_id", "order_purchase_timestamp", "amount")


def reference_date(sales: DataFrame, purchased: str = "order_purchase_timestamp") -> DataFrame:
    """One row: the day after the latest purchase (NULL without sales)."""
    return sales.agg((F.max(purchased) + F.expr("INTERVAL 1 DAY")).alias("reference_date"))


def rfm_base(
    sales: DataFrame,
    amount: str = AMOUNT,
    person: str = PERSON,
    order: str = "order_id",
    purchased: str = "order_purchase_timestamp",
    units: int = 1,
) -> DataFrame:
    """Metrics per person; sales without a known person form one NULL person.

    `amount` is best a decimal, or a whole number of which `units` make one of currency:
    both sum exactly, whole numbers at a third of the time. The reference date is a scalar
    subquery, so nothing passes through the driver.
    """
    metrics = sales.groupBy(person).agg(
        F.max(purchased).alias("last_purchase_date"),
        F.count_distinct(order).alias("frequency"),
        (F.sum(F.expr(amount)).cast("double") / units).alias("monetary"),
    )
    latest = reference_date(sales, purchased).scalar()
    return metrics.withColumn("recency", days_until(latest, F.col("last_purchase_date")))


def score_orderings(person: str = PERSON) -> dict[str, list[Column]]:
    """What each score ranks by, worst first; the person breaks ties.

    The least recent come first, and a person without any date last.
    """
    recency = F.col("recency")
    return {
        "r_score": [recency.isNull(), -recency, F.col(person)],
        "f_score": [F.col("frequency"), F.col(person)],
        "m_score": [F.col("monetary"), F.col(person)],
    }


def rfm_scores(base: DataFrame, buckets: int = 4, person: str = PERSON, **bounds: int) -> DataFrame:
    """`base` with the three scores and their string. Writes `base` to the shared folder.

    `bounds` are those of `with_ntiles`.
    """
    scored = with_ntiles(base, buckets, score_orderings(person), **bounds)
    return scored.withColumn("rfm_score_string", score_string())


def rfm_segments(
    sales: DataFrame,
    amount: str = AMOUNT,
    person: str = PERSON,
    units: int = 1,
    **bounds: int,
) -> DataFrame:
    """The gold table: metrics, scores and segment of every person."""
    scores = rfm_scores(rfm_base(sales, amount, person, units=units), person=person, **bounds)
    return scores.withColumn("rfm_segment", segment())
