"""Opt-in cleaning: duplicates and missing keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def drop_copies(df: DataFrame) -> DataFrame:
    """One of each set of identical rows. Copies are combined before the shuffle."""
    return df.dropDuplicates()


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """The first row per key under `newest_first`; NULL is a key like any other.

    The remaining columns break ties, so the result does not depend on the order of input.
    The filter on row_number lets Spark keep one row per key and task before the shuffle,
    so a hot key costs the final task one row per input task.
    """
    rest = [F.col(c).asc_nulls_last() for c in df.columns if c not in keys]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first, *rest))
    return df.withColumn("__rank", rank).filter(F.col("__rank") == 1).drop("__rank")


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key columns are all present."""
    return df.na.drop(subset=list(keys))
