"""Exact sums and averages against Python's decimals."""

import math
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from orestrata.functions.exact import sums
from orestrata.functions.rounding import rounded_average
from orestrata.plans import rfm


def _average(values):
    exact = sum(map(Decimal, values)) / len(values)
    return float(exact.quantize(Decimal("0.01"), ROUND_HALF_UP))


def _total(df):
    """The sum of `v`, put together from its words."""
    whole, behind = (word.alias(name) for word, name in zip(sums(F.col("v"), 4), ("whole", "behind"), strict=True))
    row = df.agg(whole, behind).first()
    return None if row.whole is None else row.whole + row.behind.scaleb(-4)


def test_sums_in_words(spark):
    random.seed(1)
    values = [Decimal(random.randint(-(10**16), 10**16)).scaleb(-4) for _ in range(500)] + [None, Decimal("-0.0001"), Decimal("0.9999")]
    df = spark.createDataFrame([(v,) for v in values], "v decimal(20,4)").repartition(9)
    assert _total(df) == sum(v for v in values if v is not None)
    assert _total(df.filter("v IS NULL")) is None


def test_sums_beyond_a_word_of_units(spark):
    """10,000 times 9 * 10^14 and a bit: over 2^63 units of the last place."""
    value = Decimal("900000000000000.0001")
    total = _total(spark.range(10_000).select(F.lit(value).cast("decimal(20,4)").alias("v")))
    assert total == 10_000 * value and total.scaleb(4) > 2**63


@pytest.mark.parametrize("kind", ["double", "decimal(20,4)"])
def test_money_of_orders(spark, rows, kind):
    """An item without freight counts for nothing."""
    items = spark.createDataFrame([(1, "10.0101", "0.5"), (1, "7", None), (2, "3", None), (3, "-1.5", "0.25")], "order_id int, price string, freight_value string")
    items = items.withColumns({c: F.col(c).cast(kind) for c in ("price", "freight_value")})
    orders = spark.createDataFrame([(i, 1, "2018-01-01") for i in (1, 2, 3, 4)], "order_id int, customer_id int, order_purchase_timestamp string")
    people = spark.createDataFrame([(1, 9)], "customer_id int, customer_unique_id int")
    sales = rfm.order_sales(orders, people, items)
    assert [(r[0], None if r[1] is None else float(r[1])) for r in rows(sales, "order_id", "amount")] == [(1, 10.5101), (2, None), (3, -1.25), (4, None)]
    assert rfm.rfm_base(sales, "amount").first().monetary == pytest.approx(9.2601)


def test_averages_near_half_a_cent(spark):
    cases = {
        "half": ["0.005"], "below": ["0.00", "0.009999"], "negative": ["-0.005"], "thirds": ["0.01", "0.01", "0.02"],
        "binary": ["1.005"], "sum": ["0.1"] * 3 + ["0.205"], "large": ["123456789012.345"] * 2,
    }
    data = [(name, float(v)) for name, values in cases.items() for v in values] + [("half", None), ("nothing", None)]
    got = spark.createDataFrame(data, "name string, v double").groupBy("name").agg(rounded_average("v").alias("a")).collect()
    want = {name: _average(values) for name, values in cases.items()} | {"nothing": None}
    assert {r.name: r.a for r in got} == want


def test_averages_of_other_types(spark):
    df = spark.createDataFrame([(1, Decimal("0.015"), 2**53), (2, Decimal("0.015"), 2**53 + 2)], "i int, d decimal(10,3), l bigint")
    assert tuple(df.agg(rounded_average("i"), rounded_average("d"), rounded_average("l", 0)).first()) == (1.5, 0.02, float(2**53 + 1))


@pytest.mark.parametrize("bad, want", [(math.nan, math.nan), (math.inf, math.inf)])
def test_averages_of_what_is_not_finite(spark, bad, want):
    got = spark.createDataFrame([(1.0,), (bad,)], "v double").agg(rounded_average("v")).first()[0]
    assert got == want or math.isnan(got) and math.isnan(want)


def test_same_bits_for_any_partitioning(spark):
    """Amounts whose average lies within 10^-9 of half a cent."""
    random.seed(3)
    values = [round(random.uniform(0, 5000), 4) for _ in range(4999)]
    rest = Decimal("1234.565") * 5000 - sum(Decimal(repr(v)) for v in values)
    values.append(float(rest))
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = {df.repartition(n).agg(rounded_average("v")).first()[0].hex() for n in (1, 7, 200) for _ in range(2)}
    assert got == {(1234.57).hex()}
