"""Insert-or-replace by key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orestrata.sources.partitions import replace_keys
from orestrata.sources.scratch import materialize


def _one_row_per_key(updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`updates`, failing when the plan runs if two rows share a key."""
    others = [c for c in updates.columns if c not in keys]
    message = f"several updates for one key ({', '.join(keys)})"
    return (
        updates.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("__rows"), *[F.first(c).alias(c) for c in others])
        .filter(F.when(F.col("__rows") == 1, True).otherwise(F.raise_error(message).cast("boolean")))
        .select(*updates.columns)
    )


def upsert(base: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`base` with the rows of `updates` put in place of those with the same key.

    Keys compare null-safe. A key repeated in `base` loses all its rows to the update; a
    key repeated in `updates` is an error.
    """
    replaced = updates.select(*[F.col(k).alias(f"__{k}") for k in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    return base.join(replaced, same, "left_anti").unionByName(_one_row_per_key(updates, keys))


def upsert_table(spark: SparkSession, path: str, updates: DataFrame, keys: Sequence[str], partition_by: Sequence[str]) -> int:
    """The same in the stored table at `path`, partitioned by `partition_by`; returns how many
    partitions were written again.

    These are the ones that hold an old row of a key, or receive its new one. `updates` has
    the table's columns; a key that it repeats is an error before anything is changed. After
    a crash run it again.
    """
    updates = materialize(updates, "updates")
    repeated = updates.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").first()
    if repeated:
        raise ValueError(f"several updates for one key: {dict(zip(keys, repeated, strict=False))}")
    return replace_keys(spark, path, updates.select(*keys), updates, keys, partition_by)
