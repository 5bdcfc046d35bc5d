"""Timestamp normalization."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def as_timestamps(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """String columns as timestamps, NULL where the text is none; typed columns unchanged."""
    return df.withColumns({
        c: F.try_to_timestamp(F.col(c)) for c in columns if isinstance(df.schema[c].dataType, StringType)
    })


def days_until(reference: Column, moment: Column) -> Column:
    """Whole calendar days from `moment` to `reference`; the time of day does not count."""
    return F.datediff(reference, moment)
