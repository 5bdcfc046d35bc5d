"""The stages of a full run, with their reads and writes.

Stage order: ingest, register, check, silver, gold. Every stage replaces its tables by new
versions, so running it again gives the same result, and a stage that fails leaves the old
tables as they were.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass
from hashlib import sha256

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from orestrata.plans import reports
from orestrata.plans.rfm import rfm_segments
from orestrata.plans.silver import CANCELED, build_silver
from orestrata.sources import files, paths, tables
from orestrata.sources.registry import DATASETS, GOLD_SEGMENTS, SILVER_SALES, Dataset, layer_path, source_path
from orestrata.sources.scratch import materialize, run_scope

# Catalog names.
BRONZE_PREFIX = "bronze_"
SILVER_TABLE = "silver_sales"
GOLD_TABLE = "gold_rfm_segments"
# Where a run notes its finished stages, and how many datasets are ingested side by side.
RUN_LOG = "_run.json"
INGEST_THREADS = 4


@dataclass(frozen=True)
class Ingested:
    """Rows read from the raw files, rows found in the written table, and values that do not
    fit their declared type and became NULL."""

    rows_read: int
    rows_written: int
    unreadable: int


def ingest(
    spark: SparkSession,
    raw_base: str,
    base: str,
    datasets: Iterable[Dataset] = DATASETS,
    *,
    infer: bool = False,
) -> dict[str, int]:
    """Write every raw dataset to its bronze table; returns the rows written.

    Fails before the first write if any input is missing.
    """
    counted = ingest_counts(spark, raw_base, base, datasets, infer=infer)
    return {name: counts.rows_written for name, counts in counted.items()}


def ingest_counts(
    spark: SparkSession,
    raw_base: str,
    base: str,
    datasets: Iterable[Dataset] = DATASETS,
    *,
    infer: bool = False,
    rejects: bool = False,
) -> dict[str, Ingested]:
    """The same, with what was read and what was lost; counted while the files are read.

    Datasets do not depend on each other, so some are ingested side by side. With `rejects`,
    what was lost is also written, to the table `rejects/<dataset>`: file, line, column_name,
    text and reason. The files are still parsed once; types are then declared, not inferred.
    """
    if infer and rejects:
        raise ValueError("inferred types reject nothing")
    datasets = tuple(datasets)
    files.check_inputs(spark, raw_base, datasets)

    def write(dataset: Dataset) -> Ingested:
        path = layer_path(base, "bronze", dataset.name)
        seen = Observation()
        if rejects:
            read = files.read_rejecting(spark, source_path(raw_base, dataset), types=dataset.types, multi_line=dataset.multi_line)
            lost = F.sum(F.size(F.filter(files.REJECTED, lambda r: r["column_name"].isNotNull())))
            counts = (F.count(F.lit(1)).alias("rows"), F.coalesce(lost, F.lit(0)).alias("unreadable"))
            read = materialize(read.observe(seen, *counts), "parsed")
            tables.publish(read.drop(files.FILE, files.LINE, files.REJECTED), path)
            tables.publish(files.rejects(read), layer_path(base, "rejects", dataset.name))
        else:
            tables.publish(files.read_dataset(spark, raw_base, dataset, infer=infer, seen=seen), path)
        return Ingested(seen.get["rows"], tables.row_count(spark, path), seen.get["unreadable"])

    with ThreadPoolExecutor(INGEST_THREADS) as pool:
        return dict(zip([d.name for d in datasets], pool.map(write, datasets), strict=True))


def register_bronze(
    spark: SparkSession,
    base: str,
    datasets: Iterable[Dataset] = DATASETS,
    database: str = "default",
    *,
    replace: bool = True,
) -> list[str]:
    """Make the bronze tables known to the catalog; returns their names."""
    paths = {d.name: layer_path(base, "bronze", d.name) for d in datasets}
    return tables.register_all(spark, paths, database, BRONZE_PREFIX, replace=replace)


def check(spark: SparkSession, database: str = "default") -> DataFrame:
    """Row and column check of every registered bronze table."""
    listed = tables.tables(spark, database, f"{BRONZE_PREFIX}*").collect()
    return reports.table_check(spark, sorted(f"{database}.{row.tableName}" for row in listed))


def silver(
    spark: SparkSession,
    base: str,
    database: str = "default",
    excluded: str = CANCELED,
    *,
    drop_duplicates: bool = False,
    required: Sequence[str] = (),
) -> int:
    """Write and register the silver sales table; returns its rows."""
    orders, customers, items, products = (
        tables.table_or_register(
            spark, f"{database}.{BRONZE_PREFIX}{name}", layer_path(base, "bronze", name)
        )
        for name in ("orders", "customers", "order_items", "products")
    )
    path = layer_path(base, "silver", SILVER_SALES)
    sales = build_silver(
        orders, customers, items, products, excluded, drop_duplicates=drop_duplicates, required=required
    )
    tables.publish(sales, path, name=f"{database}.{SILVER_TABLE}")
    return tables.row_count(spark, path)


def gold(spark: SparkSession, base: str, database: str = "default") -> int:
    """Write and register the segment table, partitioned by segment; returns its rows."""
    sales = tables.table_or_register(
        spark, f"{database}.{SILVER_TABLE}", layer_path(base, "silver", SILVER_SALES)
    )
    path = layer_path(base, "gold", GOLD_SEGMENTS)
    tables.publish(rfm_segments(sales), path, ["rfm_segment"], f"{database}.{GOLD_TABLE}")
    return tables.row_count(spark, path)


def gold_table(spark: SparkSession, base: str, database: str = "default") -> DataFrame:
    """The registered segment table."""
    return tables.table_or_register(
        spark, f"{database}.{GOLD_TABLE}", layer_path(base, "gold", GOLD_SEGMENTS)
    )


def fingerprint(spark: SparkSession, raw_base: str, datasets: Iterable[Dataset], **options) -> str:
    """A hash of the raw files' names, sizes and times, of the datasets and of all options."""
    inputs = [(asdict(d), paths.files_below(spark, source_path(raw_base, d))) for d in datasets]
    return sha256(json.dumps([inputs, options], sort_keys=True, default=list).encode()).hexdigest()


class RunLog:
    """What an unfinished run over the same inputs has done, in `<base>/_run.json`."""

    def __init__(self, spark: SparkSession, base: str, mark: str):
        self.spark, self.path, self.mark = spark, f"{base.rstrip('/')}/{RUN_LOG}", mark
        found = json.loads(paths.read_text(spark, self.path) or "{}")
        self.done = found["done"] if found.get("mark") == mark else {}

    def stage(self, name: str, run: Callable[[], dict], written: Sequence[str] = ()) -> dict:
        """The counts of a stage: noted ones, if the tables that it has `written` are still the
        current ones; else it runs and is noted."""
        known = self.done.get(name)
        if known and known["tables"] == [tables.table_path(self.spark, path) for path in written]:
            return known["counts"]
        counts = run()
        # Whatever was built on an older result is not done.
        self.done[name] = {"counts": counts, "tables": [tables.table_path(self.spark, path) for path in written]}
        for later in list(self.done)[list(self.done).index(name) + 1 :]:
            del self.done[later]
        paths.write_text(self.spark, self.path, json.dumps({"mark": self.mark, "done": self.done}))
        return counts

    def close(self) -> None:
        paths.remove(self.spark, self.path)


def run_all(
    spark: SparkSession,
    raw_base: str,
    base: str,
    datasets: Iterable[Dataset] = DATASETS,
    database: str = "default",
    *,
    excluded: str = CANCELED,
    infer: bool = False,
    drop_duplicates: bool = False,
    required: Sequence[str] = (),
    rejects: bool = False,
) -> dict[str, dict[str, int]]:
    """All stages in order; returns the rows that each counted.

    After a failure, the next run over the same files with the same options takes up where it
    stopped: stages whose tables are still there are not run again. A run that ends well
    leaves nothing to take up, and none leaves intermediate tables.
    """
    datasets = tuple(datasets)
    options = {"excluded": excluded, "infer": infer, "drop_duplicates": drop_duplicates, "required": list(required), "rejects": rejects}
    files.check_inputs(spark, raw_base, datasets)
    log = RunLog(spark, base, fingerprint(spark, raw_base, datasets, database=database, **options))
    with run_scope(spark):
        bronze = [layer_path(base, "bronze", d.name) for d in datasets]

        def ingested() -> dict[str, int]:
            counted = ingest_counts(spark, raw_base, base, datasets, infer=infer, rejects=rejects)
            return {name: counts.rows_written for name, counts in counted.items()}

        def checked() -> dict[str, int]:
            return {row.table_name: row.row_count for row in check(spark, database).collect()}

        def joined() -> dict[str, int]:
            return {SILVER_TABLE: silver(spark, base, database, excluded, drop_duplicates=drop_duplicates, required=required)}

        counted = {"ingest": log.stage("ingest", ingested, bronze)}
        register_bronze(spark, base, datasets, database)
        counted["check"] = log.stage("check", checked)
        counted["silver"] = log.stage("silver", joined, [layer_path(base, "silver", SILVER_SALES)])
        counted["gold"] = log.stage("gold", lambda: {GOLD_TABLE: gold(spark, base, database)}, [layer_path(base, "gold", GOLD_SEGMENTS)])
    log.close()
    return counted
