"""Columnar tables: overwrite and versioned sinks, path reads, catalog registration and listing."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orestrata.sources import paths


# Codec of tables: about two thirds of the bytes of Spark's default.
COMPRESSION = "zstd"


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def _text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrite the files at `path`, schema included.

    In place: until it ends, and after a failure, readers find no whole table. Tables that
    others read are replaced by `publish`.

    A partitioned table is first rebalanced by its partition columns: each value lands in
    few files, and a value that holds much of the data is split over several tasks.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path, compression=COMPRESSION)


def publish(df: DataFrame, path: str, partition_by: Sequence[str] = (), name: str | None = None) -> str:
    """Replace the table at `path`, and under `name` in the catalog, all at once.

    The rows go to a new version; `read_table` finds it once it is finished, and the name is
    then switched to it. If the write fails, both keep the old rows. Queries that have begun
    go on with the version they found, until `remove_old_versions` is called. Returns the
    version's folder.
    """
    spark = df.sparkSession
    version = paths.new_version(spark, path)
    write_table(df, version, partition_by)
    if name:
        register_table(spark, name, version, replace=True)
    return version


def remove_old_versions(spark: SparkSession, path: str, keep: int = 0) -> list[str]:
    """Delete all versions before the current one but the `keep` newest finished of them, and
    what unfinished writes left there; returns the names. Writes that are newer than the
    current version may still be running and stay."""
    current = paths.current_version(spark, path)
    if current is None:
        return []
    older = [name for name in paths.versions(spark, path) if name < current.rsplit("/", 1)[1]]
    finished = [name for name in older if paths.exists(spark, f"{path}/{name}/{paths.FINISHED}")]
    removed = [name for name in older if name not in finished[len(finished) - keep :]]
    for name in removed:
        paths.remove(spark, f"{path}/{name}")
    return removed


def table_path(spark: SparkSession, path: str) -> str:
    """Where the files of the table at `path` are now: its current version, if it has any."""
    return paths.current_version(spark, path) or path


def read_table(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """The table at `path`; with a schema given, no job looks for one in the files."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(table_path(spark, path))


def row_count(spark: SparkSession, path: str) -> int:
    """Rows of a written table, answered from file footers rather than by a second run of
    the plan that wrote it."""
    return read_table(spark, path).count()


def create_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    where = f" LOCATION {_text(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)}{where}")


def _create(spark: SparkSession, name: str, place: str) -> None:
    # Partitions are found in the files, so that one change of the table's location moves
    # them all; kept in the catalog, each would keep a location of its own.
    option = "spark.sql.hive.manageFilesourcePartitions"
    before = spark.conf.get(option)
    spark.conf.set(option, "false")
    try:
        spark.sql(f"CREATE TABLE IF NOT EXISTS {_quoted(name)} USING PARQUET LOCATION {_text(place)}")
    finally:
        spark.conf.set(option, before)


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(name)}").collect()
    return {row.col_name: row.data_type for row in rows}


def _switch(spark: SparkSession, name: str, place: str) -> None:
    """Point a known external table to the files at `place`.

    One change of the catalog, if the columns are the same or new ones follow the old. Other
    columns need a new definition, as do partitions that the catalog keeps.
    """
    described = _properties(spark, name)
    if described.get("Type") != "EXTERNAL":
        raise ValueError(f"{name} owns its files; drop it yourself")
    found = spark.read.parquet(place).schema  # fails before the name is given up
    known = spark.table(name).schema
    old = [(f.name, f.dataType) for f in known]
    new = [(f.name, f.dataType) for f in found]
    # Partition columns come last, so a partitioned table cannot have columns added behind.
    partitioned = "# Partition Information" in described
    grown = new[: len(old)] == old and (new == old or not partitioned)
    if not grown or described.get("Partition Provider") == "Catalog":
        spark.sql(f"DROP TABLE {_quoted(name)}")
        _create(spark, name, place)
        return
    if new != old:
        added = ", ".join(f"`{column}` {kind.simpleString()}" for column, kind in new[len(old) :])
        spark.sql(f"ALTER TABLE {_quoted(name)} ADD COLUMNS ({added})")
    if paths.qualified(spark, described["Location"]) != place:
        spark.sql(f"ALTER TABLE {_quoted(name)} SET LOCATION {_text(place)}")


def register_table(spark: SparkSession, name: str, path: str, *, replace: bool = False) -> None:
    """Make the table at `path` known as `name` and current with the files there.

    An existing definition is kept unless `replace` is set, which also follows a changed
    schema or location. Only external tables are replaced, so no file is ever deleted.
    """
    place = paths.qualified(spark, table_path(spark, path))
    if not spark.catalog.tableExists(name):
        _create(spark, name, place)
    elif replace:
        _switch(spark, name, place)
    if _properties(spark, name).get("Partition Provider") == "Catalog":
        # Made elsewhere: the catalog keeps stale partitions after an overwrite.
        spark.sql(f"MSCK REPAIR TABLE {_quoted(name)} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)


def register_all(
    spark: SparkSession,
    places: Mapping[str, str],
    database: str = "default",
    prefix: str = "",
    *,
    replace: bool = False,
) -> list[str]:
    """Register every (table, path) pair; returns the full names."""
    create_database(spark, database)
    names = []
    for table, path in places.items():
        name = f"{database}.{prefix}{table}"
        register_table(spark, name, path, replace=replace)
        names.append(name)
    return names


def table_or_register(spark: SparkSession, name: str, path: str) -> DataFrame:
    """The catalog table of `path` with its present files and partitions.

    A name that is not known, or stands for another place or an older version, is registered
    for `path`, which must hold a table. Any spelling of a place is that place.
    """
    place = table_path(spark, path)
    known = spark.catalog.tableExists(name)
    if not known or location(spark, name) != paths.qualified(spark, place):
        register_table(spark, name, place, replace=known)
    else:
        register_table(spark, name, place)
    return spark.table(name)


def location(spark: SparkSession, name: str) -> str:
    """Folder of a catalog table, qualified."""
    return paths.qualified(spark, _properties(spark, name)["Location"])


def databases(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW DATABASES")


def tables(spark: SparkSession, database: str = "default", pattern: str | None = None) -> DataFrame:
    """Tables of a database, optionally those matching a glob such as `gold*`."""
    like = f" LIKE {_text(pattern)}" if pattern else ""
    return spark.sql(f"SHOW TABLES IN {_quoted(database)}{like}").filter(~F.col("isTemporary"))


def describe(spark: SparkSession, names: Iterable[str]) -> DataFrame:
    """One row per column of each catalog table: table, position, column, type."""
    rows = [
        (name, position, column.name, column.dataType)
        for name in names
        for position, column in enumerate(spark.catalog.listColumns(name))
    ]
    return spark.createDataFrame(rows, "table_name string, position int, column_name string, data_type string")
