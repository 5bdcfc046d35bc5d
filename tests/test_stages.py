"""The stages end to end on small raw files."""

import pytest

from orestrata import __main__ as command
from orestrata.plans import reports, stages
from orestrata.sources import paths, scratch, tables
from orestrata.sources.registry import DATASETS

FILES = {
    "orders": """order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,\
order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date
o1,c1,delivered,2018-01-01 10:00:00,2018-01-01 11:00:00,2018-01-02 00:00:00,2018-01-03 00:00:00,2018-01-09 00:00:00
o2,c2,shipped,2018-02-01 10:00:00,,,,2018-02-09 00:00:00
o3,c3,canceled,2018-03-01 10:00:00,,,,2018-03-09 00:00:00
o4,c4,delivered,2018-02-20 23:59:00,,,,2018-03-01 00:00:00
""",
    "customers": """customer_id,customer_unique_id,customer_zip_code_prefix
c1,p1,01001
c2,p1,01001
c3,p3,02002
c4,p4,03003
""",
    "order_items": """order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value
o1,1,x,s,2018-01-05 00:00:00,10.00,1.10
o1,2,y,s,2018-01-05 00:00:00,20.00,2.20
o2,1,x,s,2018-02-05 00:00:00,5.00,0.50
o3,1,x,s,2018-03-05 00:00:00,99.00,9.00
""",
    "products": "product_id,product_category_name\nx,toys\ny,art\n",
    "reviews": 'review_id,order_id,review_score,review_comment_message\nr1,o1,5,"fine,\nreally"\nr2,o2,1,\n',
    "sellers": "seller_id,seller_city\ns,here\n",
    "geolocation": "geolocation_zip_code_prefix,geolocation_city\n01001,here\n",
    "order_payments": "order_id,payment_type,payment_value\no1,card,33.30\n",
    "category_name_translation": "product_category_name,product_category_name_english\nart,art\n",
}


@pytest.fixture
def raw(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    for name, text in FILES.items():
        (folder / f"{name}.csv").write_text(text)
    return str(folder)


@pytest.mark.parametrize("infer", [False, True])
def test_full_run_twice(spark, tmp_path, raw, rows, infer):
    base, database = str(tmp_path / "base"), f"run_{infer}".lower()
    tables.create_database(spark, database, str(tmp_path / "db"))
    first = stages.run_all(spark, raw, base, DATASETS, database, infer=infer)
    assert first["ingest"] == {
        "orders": 4, "order_items": 4, "products": 2, "customers": 4, "reviews": 2, "sellers": 1,
        "geolocation": 1, "order_payments": 1, "category_name_translation": 1,
    }
    assert first["check"] == {f"bronze_{name}": n for name, n in first["ingest"].items()}
    assert first["silver"] == {"silver_sales": 4} and first["gold"] == {"gold_rfm_segments": 2}
    gold = stages.gold_table(spark, base, database)
    before = rows(gold)
    metrics = rows(gold, "customer_unique_id", "frequency", "monetary", "recency", "rfm_score_string", "rfm_segment")
    assert metrics == [
        ("p1", 2, 38.8, 20, "122", "Lost Customers"), ("p4", 1, None, 1, "211", "At Risk"),
    ]
    assert stages.run_all(spark, raw, base, DATASETS, database, infer=infer) == first
    assert rows(stages.gold_table(spark, base, database)) == before
    quality = reports.silver_quality(spark.table(f"{database}.silver_sales")).first()
    assert tuple(quality) == (4, 0, 0)


def test_codes_stay_text(spark, tmp_path, raw):
    stages.ingest(spark, raw, str(tmp_path))
    customers = tables.read_table(spark, f"{tmp_path}/bronze/customers")
    assert dict(customers.dtypes)["customer_zip_code_prefix"] == "string"
    assert customers.filter("customer_zip_code_prefix = '01001'").count() == 2


def test_nothing_is_written_when_an_input_is_missing(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "orders.csv").write_text(FILES["orders"])
    with pytest.raises(FileNotFoundError, match="products"):
        stages.ingest(spark, str(folder), str(tmp_path / "base"))
    assert not (tmp_path / "base").exists()


@pytest.mark.parametrize("failing", ["silver", "gold"])
def test_a_run_takes_up_where_it_failed(spark, tmp_path, raw, monkeypatch, failing):
    base, database = str(tmp_path / "base"), f"resumed_{failing}"
    tables.create_database(spark, database, str(tmp_path / "db"))
    calls = []
    real = {name: getattr(stages, name) for name in ("ingest_counts", "check", "silver", "gold")}

    def counted(name, broken):
        def run(*args, **kwargs):
            calls.append(name)
            if broken:
                raise RuntimeError("broken")
            return real[name](*args, **kwargs)

        return run

    for name in real:
        monkeypatch.setattr(stages, name, counted(name, name == failing))
    with pytest.raises(RuntimeError, match="broken"):
        stages.run_all(spark, raw, base, DATASETS, database)
    before = set(paths.children(spark, scratch.shared_folder(spark)))
    calls.clear()
    monkeypatch.setattr(stages, failing, counted(failing, False))
    resumed = stages.run_all(spark, raw, base, DATASETS, database)
    assert calls == {"silver": ["silver", "gold"], "gold": ["gold"]}[failing]
    assert resumed["ingest"]["orders"] == 4 and resumed["gold"] == {"gold_rfm_segments": 2}
    assert set(paths.children(spark, scratch.shared_folder(spark))) <= before
    assert not (tmp_path / "base" / stages.RUN_LOG).exists()
    calls.clear()
    assert stages.run_all(spark, raw, base, DATASETS, database) == resumed
    assert calls == ["ingest_counts", "check", "silver", "gold"]


def test_other_inputs_or_tables_are_not_taken_up(spark, tmp_path, raw):
    base = str(tmp_path / "base")
    some = [d for d in DATASETS if d.name in ("orders", "sellers")]
    mark = stages.fingerprint(spark, raw, some, excluded="x")
    assert mark == stages.fingerprint(spark, raw, some, excluded="x")
    assert mark != stages.fingerprint(spark, raw, some, excluded="y") != stages.fingerprint(spark, raw, DATASETS, excluded="y")
    path = f"{base}/bronze/sellers"
    log = stages.RunLog(spark, base, mark)
    write = lambda n: lambda: [tables.publish(spark.range(n), path), {"sellers": n}][1]
    assert log.stage("ingest", write(1), [path]) == {"sellers": 1}
    assert log.stage("silver", lambda: {"s": 1}) == {"s": 1}
    assert stages.RunLog(spark, base, mark).stage("ingest", write(2), [path]) == {"sellers": 1}
    tables.publish(spark.range(5), path)  # someone else's write
    log = stages.RunLog(spark, base, mark)
    assert log.stage("ingest", write(3), [path]) == {"sellers": 3} and list(log.done) == ["ingest"]
    assert stages.RunLog(spark, base, "other").done == {}
    with open(f"{raw}/sellers.csv", "a") as file:
        file.write("t,there\n")
    assert stages.fingerprint(spark, raw, some, excluded="x") != mark


def test_scopes_remove_what_is_in_them(spark):
    with pytest.raises(KeyError), scratch.run_scope(spark) as outer:
        with scratch.run_scope(spark) as inner:
            assert inner.startswith(outer)
            scratch.materialize(spark.range(3))
            assert paths.children(spark, inner)
        assert not paths.exists(spark, inner) and paths.exists(spark, outer)
        raise KeyError
    assert not paths.exists(spark, outer)
    assert "run-" not in scratch.scratch_path(spark, "x")


def test_rejects_have_line_column_and_text(spark, tmp_path, rows):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "order_items.csv").write_text(
        "order_id,order_item_id,price,freight_value\n"
        'o1,1,10.00,1\n"o,2",x,cheap,2\no3,3,,\no4,4,5\no5,5,6,7,8\n"o""6",6,1e2,9\n'
    )
    datasets = [d for d in DATASETS if d.name == "order_items"]
    counted = stages.ingest_counts(spark, str(raw), str(tmp_path), datasets, rejects=True)["order_items"]
    assert (counted.rows_read, counted.rows_written, counted.unreadable) == (6, 6, 2)
    got = rows(tables.read_table(spark, f"{tmp_path}/rejects/order_items"), "line", "column_name", "text", "reason", "file")
    assert got == [
        ('"o,2",x,cheap,2', "order_item_id", "x", "not a int", "order_items.csv"),
        ('"o,2",x,cheap,2', "price", "cheap", "not a decimal(20,4)", "order_items.csv"),
        ("o4,4,5", None, "o4,4,5", "wrong number of fields", "order_items.csv"),
        ("o5,5,6,7,8", None, "o5,5,6,7,8", "wrong number of fields", "order_items.csv"),
    ]
    kept = tables.read_table(spark, f"{tmp_path}/bronze/order_items")
    plain = stages.ingest_counts(spark, str(raw), f"{tmp_path}/plain", datasets)["order_items"]
    assert (plain.rows_read, plain.unreadable) == (6, 2)
    assert rows(kept) == rows(tables.read_table(spark, f"{tmp_path}/plain/bronze/order_items"))
    with pytest.raises(ValueError, match="reject nothing"):
        stages.ingest_counts(spark, str(raw), str(tmp_path), datasets, infer=True, rejects=True)


def test_command_line_prints_reports_and_previews(spark, tmp_path, raw, monkeypatch, capfd):
    """The previews show what the tables hold."""
    monkeypatch.setattr(command, "build_session", lambda *args: spark)
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    base = str(tmp_path / "base")
    tables.create_database(spark, "command", str(tmp_path / "db"))

    def run(stage, *more):
        monkeypatch.setattr("sys.argv", ["orestrata", stage, "--raw", raw, "--base", base, "--database", "command", *more])
        command.main()
        return capfd.readouterr().out

    assert "'gold': {'gold_rfm_segments': 2}" in run("all", "--rejects")
    report = [line.split("|")[1:-1] for line in run("report").splitlines() if line.startswith("|")]
    lines = [[cell.strip() for cell in line] for line in report]
    assert lines[:3] == [
        ["rfm_segment", "customer_count", "avg_monetary", "avg_recency", "avg_frequency"],
        ["At Risk", "1", "NULL", "1.0", "1.0"], ["Lost Customers", "1", "38.8", "20.0", "2.0"],
    ]
    shown = run("check")
    assert "bronze_reviews" in shown and "review_id,order_id,review_score,review_comment_message" in shown
