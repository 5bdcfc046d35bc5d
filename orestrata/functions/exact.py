"""Sums that do not depend on the order in which tasks finish.

A decimal is split into two whole numbers, the part before the point and the part behind it
in units of the last place. Both add up in machine words; they are joined once per group.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# Digits before the point that a word holds, with room for the sum of as many rows again.
WORD_DIGITS = 18


def words(value: Column, places: int) -> tuple[Column, Column]:
    """A decimal with at most 18 digits before the point and `places` behind: the whole number
    before the point, and what is behind it times 10^places, with the same sign."""
    value = value.cast(DecimalType(WORD_DIGITS + places, places))
    whole = value.cast("bigint")
    behind = (value - whole.cast(DecimalType(WORD_DIGITS, 0))) * F.lit(Decimal(10**places))
    return whole, behind.cast("bigint")


def sums(value: Column, places: int) -> tuple[Column, Column]:
    """Both words summed, as decimals without places. A sum past 64 bits is an error: of 2^63
    before the point, or of about 2^63 / 10^places rows."""
    return tuple(F.sum(word).cast(DecimalType(20, 0)) for word in words(value, places))


def quotient_half_up(total: Column, divisor: Column) -> Column:
    """Whole decimals divided and rounded once, halves away from zero: a whole number."""
    twice = F.abs(total) * F.lit(Decimal(2)) + divisor
    size = F.call_function("div", twice, divisor * F.lit(Decimal(2)))
    return F.when(total < 0, -size).otherwise(size)
