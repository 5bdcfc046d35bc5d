"""Replacing rows in a stored, partitioned table."""

import pytest

from orestrata.operators.upsert import upsert, upsert_table
from orestrata.sources import partitions, paths, tables

SCHEMA = "id bigint, name string, label string, n int"
ROWS = [(i, f"r{i}", "abc"[i % 3] if i % 10 else None, i % 2) for i in range(60)]


@pytest.fixture(params=[("label",), ("label", "n")], ids=["one", "two"])
def table(request, spark, tmp_path):
    path = str(tmp_path / "t")
    tables.publish(spark.createDataFrame(ROWS, SCHEMA), path, request.param)
    return path, request.param


def _files(spark, path):
    found = paths.files_below(spark, tables.table_path(spark, path))
    return {name.split("/v-")[1].split("/", 1)[1]: time for name, _, time in found if name.endswith(".parquet")}


UPDATES = [(0, "was null", "a", 0), (4, "moved", "c", 0), (7, "to null", None, 1), (100, "added", "a", 0), (101, "in a new place", "d/e", 1)]


def test_rows_move_between_partitions(spark, table, rows):
    path, by = table
    updates = spark.createDataFrame(UPDATES, SCHEMA)
    want = rows(upsert(spark.createDataFrame(ROWS, SCHEMA), updates, ["id"]), "id", "name", "label", "n")
    for _ in range(2):  # again: the same
        upsert_table(spark, path, updates, ["id"], by)
        assert rows(tables.read_table(spark, path), "id", "name", "label", "n") == want


def test_files_of_other_partitions_keep_name_and_time(spark, table):
    path, by = table
    before = _files(spark, path)
    assert upsert_table(spark, path, spark.createDataFrame([(2, "same place", "c", 0)], SCHEMA), ["id"], by) == 1
    after = _files(spark, path)
    kept = {name: time for name, time in before.items() if not name.startswith("label=c/" if len(by) == 1 else "label=c/n=0/")}
    assert kept and kept.items() <= after.items() and len(before.keys() - after.keys()) == len(before) - len(kept)


def test_a_partition_that_loses_all_rows_goes(spark, table, rows):
    path, by = table
    updates = spark.createDataFrame([(i, name, "z", n) for i, name, label, n in ROWS if label == "b"], SCHEMA)
    upsert_table(spark, path, updates, ["id"], by)
    found = tables.read_table(spark, path)
    assert found.count() == 60 and found.filter("label = 'b'").count() == 0
    assert not any(name.startswith("label=b") for name in _files(spark, path))


def test_keys_without_rows_are_deleted(spark, table):
    path, by = table
    some = spark.createDataFrame([(1,), (2,), (999,)], "id bigint")
    partitions.replace_keys(spark, path, some, spark.createDataFrame([], SCHEMA), ["id"], by)
    assert tables.read_table(spark, path).count() == 58
    every = tables.read_table(spark, path).select("id").collect()
    partitions.replace_keys(spark, path, spark.createDataFrame(every, "id bigint"), spark.createDataFrame([], SCHEMA), ["id"], by)
    assert not [name for name in _files(spark, path) if "=" in name]


def test_a_key_that_updates_repeat(spark, table, rows):
    path, by = table
    before = _files(spark, path)
    with pytest.raises(ValueError, match="several updates for one key"):
        upsert_table(spark, path, spark.createDataFrame([UPDATES[0], UPDATES[0]], SCHEMA), ["id"], by)
    assert _files(spark, path) == before
    assert upsert_table(spark, path, spark.createDataFrame([], SCHEMA), ["id"], by) == 0


def test_null_keys_and_keys_in_the_partition(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    tables.publish(spark.createDataFrame([(None, "x", "a", 0), (1, "y", "a", 0), (1, "z", None, 0)], SCHEMA), path, ["label"])
    upsert_table(spark, path, spark.createDataFrame([(None, "new", "a", 1), (1, "newer", None, 1)], SCHEMA), ["id", "label"], ["label"])
    assert rows(tables.read_table(spark, path), "id", "name", "label") == [(None, "new", "a"), (1, "newer", None), (1, "y", "a")]


@pytest.mark.parametrize("at", ["log", "overwrite", "clean"])
def test_a_crash_on_the_way(spark, table, rows, monkeypatch, at):
    """Before the log is whole the table keeps its rows; after that a rerun completes it."""
    path, by = table
    updates = spark.createDataFrame(UPDATES, SCHEMA)
    old = rows(tables.read_table(spark, path), "id", "name", "label", "n")
    want = rows(upsert(spark.createDataFrame(ROWS, SCHEMA), updates, ["id"]), "id", "name", "label", "n")

    def crash(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        if at == "log":
            patch.setattr(paths, "write_text", crash)
        elif at == "overwrite":
            patch.setattr(partitions, "finish_replacement", lambda *a, done=[]: crash() if done else done.append(1))
        else:
            remove = paths.remove
            patch.setattr(paths, "remove", lambda s, p: crash() if paths.exists(s, f"{p}/ready.json") else remove(s, p))
        with pytest.raises(KeyboardInterrupt):
            upsert_table(spark, path, updates, ["id"], by)
    if at == "overwrite":  # as if it had died between deleting a partition and writing it again
        gone = "label=a" if len(by) == 1 else "label=a/n=0"
        paths.remove(spark, f"{tables.table_path(spark, path)}/{gone}")
    elif at == "log":
        assert rows(tables.read_table(spark, path), "id", "name", "label", "n") == old
    assert partitions.finish_replacement(spark, path) == (at != "log")
    if at == "log":
        upsert_table(spark, path, updates, ["id"], by)
    assert rows(tables.read_table(spark, path), "id", "name", "label", "n") == want
    assert partitions.LOG not in paths.children(spark, tables.table_path(spark, path))


def test_only_keys_and_touched_partitions_are_scanned(spark, table):
    path, by = table
    found = spark.read.parquet(tables.table_path(spark, path))
    touched = spark.createDataFrame([("a", 0)], "label string, n int").select(*by)
    plan = found.filter(partitions._within(touched, by))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "label" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_files_of_the_log_are_moved_not_written_again(spark, table, monkeypatch):
    path, by = table
    logged = []
    write = paths.write_text

    def look(session, place, text):
        if place.endswith("ready.json"):
            found = paths.files_below(session, place.rsplit("/", 1)[0] + "/rows")
            logged.extend((name.split("/rows/")[1], size, time) for name, size, time in found if name.endswith(".parquet"))
        write(session, place, text)

    monkeypatch.setattr(paths, "write_text", look)
    updates = spark.createDataFrame([*UPDATES, (1, "leaves b", "z", 1)], SCHEMA)
    upsert_table(spark, path, updates, ["id"], by)
    place = tables.table_path(spark, path)
    present = {name.split("/v-")[1].split("/", 1)[1]: (size, time) for name, size, time in paths.files_below(spark, place)}
    assert logged and all(present.get(name) == (size, time) for name, size, time in logged)


def test_a_place_with_a_slash_in_its_name_goes(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.publish(spark.createDataFrame([(1, "x", "d/e f", 0), (2, "y", "a", 0)], SCHEMA), path, ["label"])
    upsert_table(spark, path, spark.createDataFrame([(1, "x", "a", 1)], SCHEMA), ["id"], ["label"])
    assert sorted(tuple(r) for r in tables.read_table(spark, path).select("id", "label").collect()) == [(1, "a"), (2, "a")]
