"""Replacing rows of a stored table partition by partition.

Only the partitions that hold an old or a new row of the replaced keys are written again;
files of all others stay as they are. Their new folders are first written aside, as a redo log
beside the table, and then moved into place one after the other: what a crash left in the log
is moved before anything else is done.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orestrata.sources import paths, tables

# The redo log; Spark's readers pass over names that begin with an underscore.
LOG = "_replaced"


def _same(left: Sequence[Column], right: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, [one.eqNullSafe(other) for one, other in zip(left, right, strict=True)])


def _prefixed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(c).alias(f"__{c}") for c in columns]).distinct()


def _matching(rows: DataFrame, keys: DataFrame, columns: Sequence[str], how: str) -> DataFrame:
    """Semi or anti join by null-safe equality; `keys` has the columns with a prefix."""
    return rows.join(keys, _same([F.col(c) for c in columns], [F.col(f"__{c}") for c in columns]), how)


def _within(values: DataFrame, partition_by: Sequence[str]) -> Column:
    """A filter on the partition columns that lets the scan skip other partitions. `values` are
    partitions of the table, so no more than it has folders."""
    found = values.collect()

    def among(column: str) -> Column:
        known = sorted({row[column] for row in found if row[column] is not None}, key=str)
        test = F.col(column).isin(known)
        return test | F.col(column).isNull() if any(row[column] is None for row in found) else test

    return reduce(lambda a, b: a & b, [among(c) for c in partition_by], F.lit(True))


def _folders(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Partition folders below a path, `depth` levels of them, relative to it."""
    found = [name for name in paths.children(spark, path) if "=" in name]
    return found if depth == 1 else [f"{name}/{rest}" for name in found for rest in _folders(spark, f"{path}/{name}", depth - 1)]


def _places(table: DataFrame, values: DataFrame, partition_by: Sequence[str]) -> dict[tuple, set[str]]:
    """Folders of some partitions by their values, relative to the table. Spark gives paths as URLs."""
    file = F.col("_metadata.file_path").alias("__file")
    found: dict[tuple, set[str]] = {}
    for row in table.filter(_within(values, partition_by)).select(*partition_by, file).distinct().collect():
        folder = unquote("/".join(row["__file"].split("/")[:-1][-len(partition_by) :]))
        found.setdefault(tuple(row[:-1]), set()).add(folder)
    return found


def finish_replacement(spark: SparkSession, path: str) -> bool:
    """Apply what an interrupted replacement has left in the log; whether there was anything."""
    place = tables.table_path(spark, path)
    log = f"{place}/{LOG}"
    note = paths.read_text(spark, f"{log}/ready.json")
    if note is None:
        paths.remove(spark, log)  # written in part: nothing was replaced yet
        return False
    known = json.loads(note)
    for folder in _folders(spark, f"{log}/rows", len(known["partition_by"])):
        paths.remove(spark, f"{place}/{folder}")
        paths.move(spark, f"{log}/rows/{folder}", f"{place}/{folder}")
    for folder in known["emptied"]:
        paths.remove(spark, f"{place}/{folder}")
    paths.remove(spark, log)
    spark.catalog.refreshByPath(place)
    return True


def replace_keys(
    spark: SparkSession, path: str, keys: DataFrame, rows: DataFrame, key_columns: Sequence[str], partition_by: Sequence[str]
) -> int:
    """Put `rows` in place of all rows of the table at `path` that have one of the `keys`; returns
    how many partitions were written again.

    `rows` has the table's columns. Keys compare null-safe and may repeat; a key without rows
    loses its own. Both inputs are read several times, so they should be written tables. Running
    it again, also after a crash, gives the same table. One writer at a time.
    """
    finish_replacement(spark, path)
    place = tables.table_path(spark, path)
    table = spark.read.parquet(place)
    keys = _prefixed(keys, key_columns)
    # Of the whole table, only keys and partition columns are read to find the old rows.
    slim = table.select(*dict.fromkeys([*key_columns, *partition_by]))
    old = _matching(slim, keys, key_columns, "left_semi").select(*partition_by).distinct().collect()
    rows = rows.select(*table.columns)
    new = rows.select(*partition_by).distinct().collect()
    if not old and not new:
        return 0
    places = {tuple(row) for row in [*old, *new]}
    schema = table.select(*partition_by).schema
    touched = spark.createDataFrame(sorted(places, key=str), schema)

    log = f"{place}/{LOG}"
    before = table.filter(_within(touched, partition_by))
    before = _matching(before, _prefixed(touched, partition_by), partition_by, "left_semi")
    after = _matching(before, keys, key_columns, "left_anti").unionByName(rows)
    tables.write_table(after, f"{log}/rows", partition_by)
    left = {tuple(row) for row in spark.read.schema(after.schema).parquet(f"{log}/rows").select(*partition_by).distinct().collect()}
    gone = {tuple(row) for row in old} - left
    found = _places(table, spark.createDataFrame(sorted(gone, key=str), schema), partition_by) if gone else {}
    emptied = sorted({folder for place_of in gone for folder in found[place_of]})
    paths.write_text(spark, f"{log}/ready.json", json.dumps({"partition_by": list(partition_by), "emptied": emptied}))
    finish_replacement(spark, path)
    return len(places)
