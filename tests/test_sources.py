from datetime import datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from orestrata.session import shuffle_partitions
from orestrata.sources import files, paths, scratch, tables
from orestrata.sources.registry import DATASETS, Dataset, layer_path, only, with_files


def _write(folder: Path, name: str, text: str) -> str:
    path = folder / name
    path.write_text(text)
    return str(path)


def test_quoted_fields(spark, tmp_path, rows):
    path = _write(tmp_path, "r.csv", 'id,zip,text\n1,01010,"two\nlines"\n2,02020,"a ""quoted"" word"\n3,,\n')
    df = files.read_csv(spark, path, multi_line=True)
    assert rows(df) == [("1", "01010", "two\nlines"), ("2", "02020", 'a "quoted" word'), ("3", None, None)]


def test_types_by_name(spark, tmp_path, rows):
    path = _write(tmp_path, "t.csv", "zip,price,placed\n0042,1.25,2018-01-02 03:04:05\n7,cheap,soon\n")
    df = files.read_csv(spark, path, types={"price": "decimal(18,2)", "placed": "timestamp", "absent": "int"})
    assert [t for _, t in df.dtypes] == ["string", "decimal(18,2)", "timestamp"]
    assert rows(df.withColumn("placed", F.date_format("placed", "yyyy-MM-dd HH:mm:ss"))) == [
        ("0042", Decimal("1.25"), "2018-01-02 03:04:05"), ("7", None, None),
    ]


def test_inference(spark, tmp_path):
    path = _write(tmp_path, "t.csv", "zip,price,placed\n0042,1.25,2018-01-02 03:04:05\n")
    assert [t for _, t in files.read_csv(spark, path, infer=True).dtypes] == ["int", "double", "timestamp"]


def test_schema_must_agree_with_the_header(spark, tmp_path):
    path = _write(tmp_path, "t.csv", "a,b\n1,2\n")
    assert files.read_csv(spark, path, schema="a int, b int").first() == (1, 2)
    with pytest.raises(Exception, match="header"):
        files.read_csv(spark, path, schema="b int, a int").collect()


def test_only_columns_in_use_are_parsed(spark, tmp_path):
    path = _write(tmp_path, "t.csv", "a,b,c\n1,2,3\n")
    plan = files.read_csv(spark, path, types={"a": "int"}).select("b")._jdf.queryExecution().executedPlan()
    assert "ReadSchema: struct<b:string>" in plan.toString()


def test_all_missing_inputs_are_named(spark, tmp_path):
    _write(tmp_path, "here.csv", "a\n1\n")
    datasets = [Dataset("x", "here.csv"), Dataset("y", "gone.csv"), Dataset("z", "lost.csv")]
    with pytest.raises(FileNotFoundError) as error:
        files.check_inputs(spark, str(tmp_path), datasets)
    assert "gone.csv" in str(error.value) and "lost.csv" in str(error.value)
    assert "here.csv" not in str(error.value)
    files.check_inputs(spark, str(tmp_path), datasets[:1])


def test_registry():
    assert len(DATASETS) == 9
    renamed = with_files({"orders": "my_orders.csv"})
    assert {d.name: d.file for d in renamed}["orders"] == "my_orders.csv"
    assert [d.name for d in only("products", "orders")] == ["orders", "products"]
    assert layer_path("/data/", "gold", "t") == "/data/gold/t"
    with pytest.raises(KeyError):
        with_files({"nothing": "x"})
    with pytest.raises(KeyError):
        only("nothing")


def test_overwrite_replaces_rows_and_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(spark.range(5), path)
    tables.write_table(spark.range(3).select(F.col("id").cast("string").alias("other")), path)
    assert tables.read_table(spark, path).columns == ["other"]
    assert tables.row_count(spark, path) == 3


def _labelled(spark, n, *labels):
    choice = F.array(*map(F.lit, labels))[(F.col("id") % len(labels)).cast("int")]
    return spark.range(n).withColumn("label", choice)


def test_partitioned_table_through_the_catalog(spark, tmp_path, rows):
    """A label with a slash survives; overwriting with other labels is noticed."""
    path, name = str(tmp_path / "t"), "default.test_partitioned"
    tables.write_table(_labelled(spark, 10, "A/B", "C"), path, ["label"])
    tables.register_table(spark, name, path, replace=True)
    counted = spark.table(name).groupBy("label").count()
    assert rows(counted) == [("A/B", 5), ("C", 5)]
    tables.write_table(_labelled(spark, 6, "D", "A/B"), path, ["label"])
    tables.register_table(spark, name, path)
    assert rows(spark.table(name).groupBy("label").count()) == [("A/B", 3), ("D", 3)]
    scan = spark.table(name).filter("label = 'D'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(label" in scan


def test_partitioned_write_gathers_each_value(spark, tmp_path):
    path = tmp_path / "t"
    tables.write_table(_labelled(spark, 1000, "a", "b").repartition(16), str(path), ["label"])
    assert len(list(path.glob("label=a/*.parquet"))) == 1


def test_partitioned_write_splits_a_large_value(spark, tmp_path, conf):
    conf({"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB"})
    path = tmp_path / "t"
    wide = _labelled(spark, 30_000, "a", "a", "b").withColumn("text", F.sha2(F.col("id").cast("string"), 256))
    tables.write_table(wide.repartition(8), str(path), ["label"])
    assert len(list(path.glob("label=a/*.parquet"))) > 2
    assert tables.row_count(spark, str(path)) == 30_000


def test_quotes_in_a_path(spark, tmp_path):
    path, name = str(tmp_path / "it's"), "default.test_quotes"
    tables.write_table(spark.range(2), path)
    tables.register_table(spark, name, path, replace=True)
    assert spark.table(name).count() == 2


def test_files_replaced_in_the_same_session_are_seen(spark, tmp_path):
    path, name = str(tmp_path / "t"), "default.test_refresh"
    tables.write_table(spark.range(2), path)
    tables.register_table(spark, name, path, replace=True)
    assert spark.table(name).count() == 2
    tables.write_table(spark.range(5), path)
    ids = tables.table_or_register(spark, name, path).collect()
    assert sorted(r.id for r in ids) == [0, 1, 2, 3, 4]


def test_registration_keeps_or_replaces(spark, tmp_path):
    name = "default.test_replace"
    tables.write_table(spark.range(1), str(tmp_path / "a"))
    tables.write_table(spark.range(2).toDF("other"), str(tmp_path / "b"))
    tables.register_table(spark, name, str(tmp_path / "a"), replace=True)
    tables.register_table(spark, name, str(tmp_path / "b"))
    assert spark.table(name).columns == ["id"]
    tables.register_table(spark, name, str(tmp_path / "b"), replace=True)
    assert spark.table(name).columns == ["other"]
    assert (tmp_path / "a").exists()


def test_a_table_is_registered_when_it_is_not_known(spark, tmp_path):
    name = f"default.test_{tmp_path.name.replace('-', '_')}"
    tables.write_table(spark.range(4), str(tmp_path / "t"))
    assert not spark.catalog.tableExists(name)
    assert tables.table_or_register(spark, name, str(tmp_path / "t")).count() == 4
    with pytest.raises(AnalysisException):
        tables.table_or_register(spark, name, "/nowhere")
    spark.range(7).write.parquet(str(tmp_path / "other"))
    assert tables.table_or_register(spark, name, str(tmp_path / "other")).count() == 7


def test_listing(spark, tmp_path):
    database = "test_listing"
    tables.create_database(spark, database, str(tmp_path / "db"))
    for table in ("gold_a", "gold_b", "silver_c"):
        tables.write_table(spark.range(1), str(tmp_path / table))
    paths = {t: str(tmp_path / t) for t in ("gold_a", "gold_b", "silver_c")}
    assert tables.register_all(spark, paths, database, replace=True)[0] == f"{database}.gold_a"
    spark.range(1).createOrReplaceTempView("gold_temporary")
    listed = tables.tables(spark, database, "gold*")
    assert sorted(r.tableName for r in listed.collect()) == ["gold_a", "gold_b"]
    assert tables.tables(spark, database).count() == 3
    assert database in [r[0] for r in tables.databases(spark).collect()]
    described = tables.describe(spark, [f"{database}.gold_a"]).collect()
    assert [tuple(r) for r in described] == [(f"{database}.gold_a", 0, "id", "bigint")]


def test_materialize_keeps_rows_and_types(spark):
    df = spark.createDataFrame(
        [(1, Decimal("1.5000"), datetime(2018, 1, 1), None)],
        "a int, b decimal(20,4), c timestamp_ntz, d string",
    )
    written = scratch.materialize(df)
    assert written.schema == df.schema and written.collect() == df.collect()
    assert scratch.materialize(df.limit(0)).count() == 0


def test_shared_folder_is_the_checkpoint_folder(spark, tmp_path):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        spark.sparkContext.setCheckpointDir(str(tmp_path))
    folder = configured or spark.sparkContext.getCheckpointDir()
    assert scratch.shared_folder(spark) == folder.rstrip("/")
    assert scratch.scratch_path(spark, "x").startswith(folder.rstrip("/"))
    assert scratch.scratch_path(spark, "x") != scratch.scratch_path(spark, "x")


class _Session:
    """Stands for a cluster session that names no checkpoint folder."""

    class conf:
        @staticmethod
        def get(key, default):
            return default

    class sparkContext:
        master = "yarn"

        @staticmethod
        def getCheckpointDir():
            return None


def test_a_cluster_without_a_shared_folder_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.shared_folder(_Session)


def test_shuffle_partitions():
    assert shuffle_partitions(0) == 200
    assert shuffle_partitions(100 * 1024**4) == 409_600


def test_overwritten_partitions_are_found(spark, tmp_path):
    path, name = str(tmp_path / "p"), f"default.p_{tmp_path.name.replace('-', '_')}"
    one, other = (spark.range(n).withColumn("label", F.lit(label)) for n, label in ((3, "a"), (7, "b")))
    tables.write_table(one, path, ["label"])
    assert tables.table_or_register(spark, name, path).count() == 3
    tables.write_table(other, path, ["label"])
    assert tables.table_or_register(spark, name, path).count() == 7


@pytest.mark.parametrize("how", [{}, {"infer": True}])
def test_files_with_other_headers_are_refused(spark, tmp_path, how):
    _write(tmp_path, "a.csv", "x,y\n1,2\n")
    _write(tmp_path, "b.csv", "y,x\n3,4\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_csv(spark, str(tmp_path), **how).collect()


def test_tables_are_packed_with_zstd(spark, tmp_path):
    tables.publish(spark.range(10), str(tmp_path / "t"))
    assert all(".zstd." in name for name, _, _ in paths.files_below(spark, tables.table_path(spark, str(tmp_path / "t"))) if name.endswith(".parquet"))
