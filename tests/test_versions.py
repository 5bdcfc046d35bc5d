"""Versioned tables: a write is seen whole or not at all."""

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from orestrata.sources import paths, tables


def _failing(df):
    """The same rows, of which one makes its task fail."""
    bad = F.when(F.col("id") == 3, F.raise_error("a task that fails").cast("bigint")).otherwise(F.col("id"))
    return df.withColumn("id", bad)


@pytest.fixture
def name(tmp_path):
    return f"default.v_{tmp_path.name.replace('-', '_')}"


@pytest.mark.parametrize("partition_by", [(), ("label",)])
def test_a_failed_write_keeps_the_old_rows(spark, tmp_path, name, rows, partition_by):
    path = str(tmp_path / "t")
    old = spark.range(8).withColumn("label", F.col("id") % 2)
    tables.publish(old, path, partition_by, name)
    held = spark.table(name)
    with pytest.raises(Exception, match="a task that fails"):
        tables.publish(_failing(old.repartition(8)), path, partition_by, name)
    assert rows(tables.read_table(spark, path), "id", "label") == rows(spark.table(name), "id", "label") == rows(old)
    assert len(paths.versions(spark, path)) == (1 if partition_by else 2)  # it failed before, or while, writing

    tables.publish(spark.range(3).withColumn("label", F.lit(7).cast("bigint")), path, partition_by, name)
    assert rows(tables.read_table(spark, path), "id", "label") == rows(spark.table(name), "id", "label") == [(0, 7), (1, 7), (2, 7)]
    assert rows(held, "id", "label") == rows(old)  # a reader that began before


def test_old_versions_go_when_told(spark, tmp_path, name):
    path = str(tmp_path / "t")
    assert tables.remove_old_versions(spark, path) == []
    for n in (1, 2, 3):
        tables.publish(spark.range(n), path, name=name)
    with pytest.raises(Exception, match="a task that fails"):
        tables.publish(_failing(spark.range(9)), path)
    tables.publish(spark.range(4), path, name=name)
    (tmp_path / "t" / "v-9999999999-00000000000000000000000000000000").mkdir()  # still being written
    assert len(tables.remove_old_versions(spark, path, keep=1)) == 3
    assert len(paths.versions(spark, path)) == 3
    assert len(tables.remove_old_versions(spark, path)) == 1
    assert spark.table(name).count() == tables.row_count(spark, path) == 4


def _statements(spark, monkeypatch):
    said = []
    run = type(spark).sql

    def listen(self, text, *args, **kwargs):
        said.append(text)
        return run(self, text, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", listen)
    return said


def test_any_spelling_of_a_path_is_that_place(spark, tmp_path, name, monkeypatch):
    path = str(tmp_path / "t")
    tables.publish(spark.range(5), path)
    monkeypatch.chdir(tmp_path)
    relative = os.path.relpath(path, spark._jvm.java.lang.System.getProperty("user.dir"))
    assert paths.qualified(spark, relative) == paths.qualified(spark, f"file://{path}/") == f"file:{path}"
    assert tables.table_or_register(spark, name, relative).count() == 5
    said = _statements(spark, monkeypatch)
    for spelling in (path, f"{path}/", f"file:{path}", f"file://{path}", relative, str(tmp_path / "t" / "." )):
        assert tables.table_or_register(spark, name, spelling).count() == 5
    assert {text.split()[0] for text in said} == {"DESCRIBE"}


def test_a_new_version_is_one_change_of_the_catalog(spark, tmp_path, name, monkeypatch):
    path = str(tmp_path / "t")
    one = spark.range(4).withColumn("label", F.lit("a"))
    tables.publish(one, path, ["label"], name)
    said = _statements(spark, monkeypatch)
    tables.publish(one.withColumn("label", F.lit("b")), path, ["label"], name)
    changes = [text for text in said if not text.startswith("DESCRIBE")]
    assert len(changes) == 1 and "SET LOCATION" in changes[0]
    assert [r.label for r in spark.table(name).select("label").distinct().collect()] == ["b"]


def test_added_and_changed_columns(spark, tmp_path, name):
    path = str(tmp_path / "t")
    tables.publish(spark.range(2), path, name=name)
    tables.publish(spark.range(2).withColumn("more", F.lit("x")), path, name=name)
    assert spark.table(name).columns == ["id", "more"] and spark.table(name).filter("more = 'x'").count() == 2
    tables.publish(spark.range(3).select(F.col("id").cast("string").alias("other")), path, name=name)
    assert spark.table(name).columns == ["other"] and spark.table(name).count() == 3


def test_partitions_that_the_catalog_keeps_are_moved(spark, tmp_path, name):
    """A table that someone else registered, with partitions of its own."""
    for folder, label in (("a", "x"), ("b", "y")):
        tables.write_table(spark.range(3).withColumn("label", F.lit(label)), str(tmp_path / folder), ["label"])
    spark.sql(f"CREATE TABLE {name} USING PARQUET LOCATION '{tmp_path}/a'")
    spark.sql(f"MSCK REPAIR TABLE {name}")
    assert spark.table(name).count() == 3
    found = tables.table_or_register(spark, name, str(tmp_path / "b"))
    assert [r.label for r in found.select("label").distinct().collect()] == ["y"]


def test_a_table_of_the_catalog_is_not_moved(spark, tmp_path, name):
    spark.sql(f"CREATE TABLE {name} (id bigint) USING PARQUET")
    tables.publish(spark.range(1), str(tmp_path / "t"))
    with pytest.raises(ValueError, match="owns its files"):
        tables.register_table(spark, name, str(tmp_path / "t"), replace=True)
    spark.sql(f"DROP TABLE {name}")


def test_small_files(spark, tmp_path):
    path = f"{tmp_path}/notes/x.json"
    assert paths.read_text(spark, path) is None
    for text in ("one", "zwölf"):
        paths.write_text(spark, path, text)
        assert paths.read_text(spark, path) == text
    assert [p.name for p in Path(tmp_path / "notes").iterdir() if not p.name.startswith(".")] == ["x.json"]
