"""Silver kept up with files that arrive in bronze.

A build notes which bronze files it has read. The next one looks only at what came since: the
orders that new order, customer, item or product rows belong to are found by semi-joins, joined
again whole, and put in place of their old rows. Silver is partitioned by month of purchase,
so only the months of these orders are read and written.

Bronze rows are only added. Where a file that was read is gone, or nothing was built before,
the whole table is built.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orestrata.plans.silver import CANCELED, build_silver
from orestrata.sources import paths, tables
from orestrata.sources.partitions import replace_keys
from orestrata.sources.registry import layer_path
from orestrata.sources.scratch import materialize

SALES_BY_MONTH = "sales_by_month"
MONTH = "order_month"
# The bronze tables of silver, in the order that `build_silver` takes them.
INPUTS = ("orders", "customers", "order_items", "products")
READ = "_read.txt"


@dataclass(frozen=True)
class Update:
    """Whether the whole table was built; else how many files were new, how many orders were
    joined again and how many months were written."""

    whole: bool
    files: int
    orders: int = 0
    months: int = 0


def month_of(purchased: Column) -> Column:
    """Partition of a purchase, such as `2018-02`; NULL without a date."""
    return F.date_format(purchased, "yyyy-MM")


def _in_months(sales: DataFrame) -> DataFrame:
    return sales.withColumn(MONTH, month_of(F.col("order_purchase_timestamp")))


def append(df: DataFrame, base: str, dataset: str) -> None:
    """Add rows to a bronze table as new files. Readers see them once they are complete."""
    df.write.mode("append").parquet(tables.table_path(df.sparkSession, layer_path(base, "bronze", dataset)))


def _present(spark: SparkSession, base: str) -> dict[str, list[str]]:
    """Data files of each bronze table."""
    present = {}
    for name in INPUTS:
        found = paths.files_below(spark, tables.table_path(spark, layer_path(base, "bronze", name)))
        present[name] = [path for path, _, _ in found if not path.rsplit("/", 1)[1].startswith(("_", "."))]
    return present


def changed_orders(bronze: dict[str, DataFrame], new: dict[str, DataFrame]) -> DataFrame:
    """Ids of the orders that new rows belong to: order_id, without repeats.

    Semi-joins read only key columns of the old rows, and of those that refer to new ones.
    """
    parts = [new[name].select("order_id") for name in ("orders", "order_items") if name in new]
    if "customers" in new:
        parts.append(bronze["orders"].join(new["customers"].select("customer_id"), "customer_id", "left_semi").select("order_id"))
    if "products" in new:
        parts.append(bronze["order_items"].join(new["products"].select("product_id"), "product_id", "left_semi").select("order_id"))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionAll(part)
    return every.filter("order_id IS NOT NULL").distinct()


def update_silver(spark: SparkSession, base: str, excluded: str = CANCELED) -> Update:
    """Bring the monthly silver table up to date with bronze.

    Gives the rows that a full build would give. After a crash run it again: files are noted as
    read only when their rows are in the table.
    """
    path = layer_path(base, "silver", SALES_BY_MONTH)
    present = _present(spark, base)
    bronze = {name: tables.read_table(spark, layer_path(base, "bronze", name)) for name in INPUTS}
    # The note lies in the version that it speaks of.
    version = paths.current_version(spark, path)
    note = paths.read_text(spark, f"{version}/{READ}") if version else None
    known = set((note or "").split("\n"))
    every = {file for files in present.values() for file in files}
    if note is None or known - {""} - every:
        sales = build_silver(*(bronze[name] for name in INPUTS), excluded)
        version = tables.publish(_in_months(sales), path, [MONTH])
        paths.write_text(spark, f"{version}/{READ}", "\n".join(sorted(every)))
        return Update(True, len(every))

    arrived = {name: [file for file in files if file not in known] for name, files in present.items()}
    new = {name: spark.read.schema(bronze[name].schema).parquet(*files) for name, files in arrived.items() if files}
    if not new:
        return Update(False, 0)
    ids = materialize(changed_orders(bronze, new), "changed-orders")
    some = [bronze["orders"].join(ids, "order_id", "left_semi"), bronze["customers"]]
    some += [bronze["order_items"].join(ids, "order_id", "left_semi"), bronze["products"]]
    sales = materialize(_in_months(build_silver(*some, excluded)), "changed-sales")
    months = replace_keys(spark, path, ids, sales, ["order_id"], [MONTH])
    paths.write_text(spark, f"{version}/{READ}", "\n".join(sorted(every)))
    return Update(False, sum(map(len, arrived.values())), ids.count(), months)


def sales_by_month(spark: SparkSession, base: str) -> DataFrame:
    """The silver table; a filter on `order_month` reads only those months."""
    return tables.read_table(spark, layer_path(base, "silver", SALES_BY_MONTH))
