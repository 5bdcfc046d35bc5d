"""The two left joins of a star layout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _no_shared_columns(left: DataFrame, right: DataFrame, key: str) -> None:
    shared = (set(left.columns) & set(right.columns)) - {key}
    if shared:
        raise ValueError(f"rename columns present on both sides: {sorted(shared)}")


def left_lookup(rows: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """Every row with its match in `lookup`, or NULLs.

    For a lookup side with about one row per key. Catalyst broadcasts it when its measured
    size allows; otherwise adaptive execution splits a hot key of `rows`.
    """
    _no_shared_columns(rows, lookup, key)
    return rows.join(lookup, key, "left")


def left_fan_out(heads: DataFrame, details: DataFrame, key: str) -> DataFrame:
    """Left join where one head may own very many details.

    Adaptive execution splits a hot key on both sides of an inner join, but only on the left
    side of a left join. So heads with details take an inner join; heads without are those
    that no distinct key of the details matches, and distinct keys are not hot.

    Keys alone shuffle to so few bytes that adaptive execution merges many of them into one
    task. There they go into a hash table; two sorts beside the distinct took a gigabyte.
    """
    _no_shared_columns(heads, details, key)
    owners = details.select(key).filter(F.col(key).isNotNull()).distinct().hint("shuffle_hash")
    alone = heads.join(owners, key, "left_anti").select(key, *[c for c in heads.columns if c != key])
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in details.schema if f.name != key]
    return heads.join(details, key, "inner").unionByName(alone.select("*", *missing))
