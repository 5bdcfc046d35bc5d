"""Rounded averages."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from orestrata.functions.exact import WORD_DIGITS, quotient_half_up, sums

# Decimal places to which a value counts.
PLACES = 6


def rounded_average(column: str, digits: int = 2, places: int = PLACES) -> Column:
    """Average of the non-NULL values, rounded once, half away from zero, as a double.

    Values count as the decimals that they are written as, to `places` behind the point; they
    are summed exactly and divided once, so the result is the same for any order or
    partitioning of the rows. NULL without values. A value that is not finite makes the
    average NaN or infinite; one of 10^18 or more is an error.
    """
    value, rough = F.col(column), F.col(column).cast("double")
    finite = ~F.isnan(rough) & (F.abs(rough) != float("inf"))
    whole, behind = sums(F.when(finite, value).cast(DecimalType(WORD_DIGITS + places, places)), places)
    units = whole * F.lit(Decimal(10**places)) + behind
    divisor = F.count(value).cast(DecimalType(20, 0)) * F.lit(Decimal(10 ** (places - digits)))
    exact = quotient_half_up(units, F.nullif(divisor, F.lit(0))).cast("double") / 10**digits
    return F.when(F.count_if(~finite) > 0, F.avg(rough)).otherwise(exact)
