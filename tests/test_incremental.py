"""Silver after new bronze files, against a full build."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orestrata.plans import incremental, silver
from orestrata.sources import paths, tables
from orestrata.sources.registry import layer_path

FIVE, ONE = Decimal(5), Decimal(1)
SCHEMAS = {
    "orders": "order_id string, customer_id string, order_status string, order_purchase_timestamp string, "
    "order_delivered_customer_date string, order_estimated_delivery_date string",
    "customers": "customer_id string, customer_unique_id string",
    "order_items": "order_id string, product_id string, price decimal(20,4), freight_value decimal(20,4)",
    "products": "product_id string, product_category_name string",
}


def _rows(seed, orders, customers, products, items):
    random.seed(seed)
    date = lambda m: f"2018-{m:02}-03 10:00:00"
    return {
        "orders": [
            (f"o{i}", f"c{random.randint(0, 19)}", random.choice(["ok", "canceled", None, "ok"]),
             date(1 + i % 6) if i % 11 else None, None, date(9)) for i in orders
        ],
        "customers": [(f"c{i}", f"p{i // 2}") for i in customers],
        "products": [(f"x{i}", "toys") for i in products],
        "order_items": [(f"o{i}", f"x{random.randint(0, 9)}", FIVE, ONE) for i in items],
    }


@pytest.fixture
def base(spark, tmp_path):
    base = str(tmp_path / "base")
    for name, rows in _rows(1, range(60), range(15), range(8), [i % 50 for i in range(120)]).items():
        tables.publish(spark.createDataFrame(rows, SCHEMAS[name]), layer_path(base, "bronze", name))
    return base


def _full(spark, base):
    bronze = [tables.read_table(spark, layer_path(base, "bronze", name)) for name in incremental.INPUTS]
    return silver.build_silver(*bronze)


def _agrees(spark, base, rows):
    got, want = incremental.sales_by_month(spark, base), _full(spark, base)
    return rows(got, *want.columns) == rows(want)


def _arrive(spark, base, **new):
    for name, rows in new.items():
        incremental.append(spark.createDataFrame(rows, SCHEMAS[name]), base, name)


def test_each_kind_of_arrival(spark, base, rows):
    first = incremental.update_silver(spark, base)
    assert first.whole and _agrees(spark, base, rows)
    assert incremental.update_silver(spark, base) == incremental.Update(False, 0)
    more = _rows(2, [70, 71, 77], [16, 17], [8, 9], [1, 1, 70, 200])
    for name, added in more.items():
        _arrive(spark, base, **{name: added})
        update = incremental.update_silver(spark, base)
        assert not update.whole and update.files and _agrees(spark, base, rows)
    _arrive(spark, base, **_rows(3, [80], [18], [], [80, 5]))
    assert not incremental.update_silver(spark, base).whole and _agrees(spark, base, rows)


def test_an_order_that_comes_after_its_items(spark, base, rows):
    _arrive(spark, base, order_items=[("late", "x1", FIVE, ONE)])
    incremental.update_silver(spark, base)
    _arrive(spark, base, orders=[("late", "c1", "ok", "2018-12-01 00:00:00", None, None)])
    update = incremental.update_silver(spark, base)
    assert (update.orders, update.months) == (1, 1) and _agrees(spark, base, rows)
    assert incremental.sales_by_month(spark, base).filter("order_id = 'late'").first()[incremental.MONTH] == "2018-12"


def test_old_months_are_neither_scanned_nor_written(spark, base, monkeypatch):
    incremental.update_silver(spark, base)
    place = tables.table_path(spark, layer_path(base, "silver", incremental.SALES_BY_MONTH))
    before = {f: (size, time) for f, size, time in paths.files_below(spark, place) if f.endswith(".parquet")}
    _arrive(spark, base, order_items=[("o1", "x1", FIVE, ONE)])  # an order of February
    read = {}
    write = paths.write_text

    def look(session, path, text):  # the rows of whole months that the redo log was made of
        if path.endswith("ready.json"):
            log = session.read.parquet(path.rsplit("/", 1)[0] + "/rows")
            read["months"] = {r[0] for r in log.select(incremental.MONTH).distinct().collect()}
            read["rows"] = log.count()
        write(session, path, text)

    monkeypatch.setattr(paths, "write_text", look)
    update = incremental.update_silver(spark, base)
    assert (update.orders, update.months) == (1, 1) and read["months"] == {"2018-02"}
    february = incremental.sales_by_month(spark, base).filter(F.col(incremental.MONTH) == "2018-02")
    assert read["rows"] == february.count() < incremental.sales_by_month(spark, base).count() / 3
    after = {f: (size, time) for f, size, time in paths.files_below(spark, place) if f.endswith(".parquet")}
    others = {f: v for f, v in before.items() if "=2018-02/" not in f}
    assert len(others) >= 5 and others.items() <= after.items()


def test_a_crash_before_the_note(spark, base, rows, monkeypatch):
    incremental.update_silver(spark, base)
    _arrive(spark, base, orders=[("n1", "c1", "ok", "2018-05-01 00:00:00", None, None)], order_items=[("n1", "x1", FIVE, ONE)])
    write = paths.write_text

    def crash(session, path, text):
        if path.endswith(incremental.READ):
            raise KeyboardInterrupt
        write(session, path, text)

    with monkeypatch.context() as patch:
        patch.setattr(paths, "write_text", crash)
        with pytest.raises(KeyboardInterrupt):
            incremental.update_silver(spark, base)
    assert incremental.update_silver(spark, base).orders == 1 and _agrees(spark, base, rows)


def test_replaced_bronze_is_built_anew(spark, base, rows):
    incremental.update_silver(spark, base)
    tables.publish(spark.createDataFrame([("c1", "other")], SCHEMAS["customers"]), layer_path(base, "bronze", "customers"))
    assert incremental.update_silver(spark, base).whole and _agrees(spark, base, rows)
