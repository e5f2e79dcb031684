"""Appends that count once, and readers beside reloads and archive runs."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.helpers import D, rows, star
from tests.test_storage import INVENTORY_HEADER, PRODUCTS_HEADER, SALES_HEADER, STORES_HEADER, write
from tillscope.operators.calendar import calendar
from tillscope.plans.load import SourceFiles, append_inventory, append_sales, load_star
from tillscope.sources.csv import content_digests
from tillscope.sources.warehouse import Warehouse, as_ranges, from_ranges

SALE = "{p},1,{d},10:00:00,t{p},1,9.90,0,in-store\n"
SNAPSHOT = "{p},1,{d},10,10,0,0,5.00\n"


@pytest.fixture
def loaded(spark, tmp_path, database):
    files = SourceFiles(
        write(tmp_path / "p.csv", PRODUCTS_HEADER + "1,S1,A,M,C,s,1\n2,S2,B,M,C,s,1\n"),
        write(tmp_path / "s.csv", STORES_HEADER + "1,T1,One,C,Super,N,X,Y,100,2020-01-01\n"),
        [write(tmp_path / "v.csv", SALES_HEADER + SALE.format(p=1, d="2024-01-05") + SALE.format(p=9, d="2024-01-05"))],
        write(tmp_path / "i.csv", INVENTORY_HEADER + SNAPSHOT.format(p=1, d="2024-01-01")),
    )
    warehouse = Warehouse(spark, database, str(tmp_path / "db"))
    load_star(files, calendar(spark, D("2024-01-01"), D("2024-12-31")), warehouse)
    return warehouse


def more_sales(tmp_path, name="v2.csv", products=(1, 2, 9)):
    return write(tmp_path / name, SALES_HEADER + "".join(SALE.format(p=p, d="2024-02-05") for p in products))


def sold(warehouse):
    return sorted(rows(warehouse.table("sales"), "product_id", "sale_date"))


def test_files_count_once(loaded, tmp_path):
    path = more_sales(tmp_path)
    assert [r["broken_rules"] for r in append_sales([path], loaded).collect()] == [["DQ19"]]
    after = sold(loaded)
    assert after == [(1, D("2024-01-05")), (1, D("2024-02-05")), (2, D("2024-02-05"))]
    moved = write(tmp_path / "other name.csv", open(path).read())
    assert append_sales([path, moved], loaded).count() == 0
    again = more_sales(tmp_path, "again.csv", (9, 2, 1))  # the same lines in another order
    append_sales(again, loaded)
    append_sales([str(tmp_path / "v.csv")], loaded)  # a file of the first load
    assert sold(loaded) == after
    assert sorted(rows(loaded.loaded_files(), "load", "table_name", "lines")) == [(1, "inventory", 1), (1, "sales", 2), (2, "sales", 3)]
    assert sorted(rows(loaded.rejected(), "load", "table_name")) == [(1, "sales"), (2, "sales")]


def test_equal_files_of_one_call_count_once(loaded, tmp_path):
    append_sales([more_sales(tmp_path, "a.csv"), more_sales(tmp_path, "b.csv")], loaded)
    assert len(sold(loaded)) == 3
    assert len(set(rows(loaded.table("sales"), "sale_id"))) == 3


def test_an_append_that_broke_off_can_be_repeated(loaded, tmp_path, monkeypatch):
    path, before = more_sales(tmp_path), sold(loaded)

    def fail(*args, **kwargs):
        raise RuntimeError("lost")

    for step in ("keep_rejected", "switch_fact", "_point"):
        with monkeypatch.context() as patch:
            patch.setattr(Warehouse, step, fail)
            with pytest.raises(RuntimeError):
                append_sales([path], loaded)
        assert sold(loaded) == before, step
        assert rows(loaded.rejected(), "load") == [1]
        assert loaded.loaded_files().count() == 2
    assert append_sales([path], loaded).count() == 1
    assert len(sold(loaded)) == 3 and loaded.rejected().count() == 2
    folders = {p.name for p in (tmp_path / "db" / "files").iterdir()}
    assert folders == {p["written_as"] for t in ("sales", "inventory") for p in loaded.parts(t)} | {
        loaded.properties(t)["stored_in"] for t in ("products", "stores", "calendar")
    }


def test_snapshots_are_appended_and_keep_their_key(loaded, tmp_path):
    lines = [SNAPSHOT.format(p=p, d=d) for p, d in ((1, "2024-01-01"), (1, "2024-02-01"), (2, "2024-01-01"), (2, "2024-02-01"))]
    twice = SNAPSHOT.format(p=2, d="2024-03-01") * 2
    path = write(tmp_path / "i2.csv", INVENTORY_HEADER + "".join(lines) + twice)
    rejected = append_inventory(path, loaded)
    assert rows(rejected, "broken_rules") == [["DQ4"]] * 3  # stored before; twice in the file
    stored = loaded.table("inventory")
    assert sorted(rows(stored, "product_id", "snapshot_date")) == [
        (1, D("2024-01-01")), (1, D("2024-02-01")), (2, D("2024-01-01")), (2, D("2024-02-01"))]
    keys = rows(stored, "inventory_id")
    assert len(set(keys)) == 4 and rows(stored, "stock_value") == [50] * 4
    append_inventory(path, loaded)
    assert loaded.table("inventory").count() == 4 and loaded.last_key("inventory") >= max(keys)


def test_only_the_months_of_new_snapshots_are_compared(loaded, tmp_path):
    from tillscope.plans.load import _stage, _stored_months

    path = write(tmp_path / "i3.csv", INVENTORY_HEADER + SNAPSHOT.format(p=1, d="2024-03-01"))
    compared = _stored_months("inventory", _stage("inventory", path, loaded, None), loaded)
    assert compared.inputFiles() == [] and loaded.table("inventory").inputFiles()


def test_keys_of_archived_rows_are_not_given_again(loaded, tmp_path):
    key = loaded.last_key("sales")
    assert loaded.table("sales").agg(F.max("sale_id")).first()[0] <= key
    assert loaded.archive_before(date(2025, 6, 1), "old") == {2024: 1}
    assert sold(loaded) == [] and loaded.last_key("sales") == key
    append_sales(more_sales(tmp_path), loaded)
    assert min(rows(loaded.table("sales"), "sale_id")) > key
    assert loaded.spark.table(loaded.name("old")).count() == 1


def test_readers_survive_a_reload_an_append_and_an_archive_run(spark, tmp_path, database):
    warehouse = Warehouse(spark, database, str(tmp_path / "db"))
    first = star(spark, [{"sale_date": D("2023-05-05")}, {}], [{}], first="2023-01-01")
    warehouse.write_star(first)
    opened = {name: df for name, df in warehouse.star().tables().items()}
    counts = {name: df.count() for name, df in opened.items()}
    warehouse.write_star(star(spark, [{}] * 5, [{}], first="2024-01-01"))
    warehouse.archive_year(2024, "old_sales")
    warehouse.clear()
    assert warehouse.table("sales").count() == 0 and warehouse.table("inventory").count() == 0
    assert {name: df.count() for name, df in opened.items()} == counts == {
        "products": 1, "stores": 1, "calendar": 731, "sales": 2, "inventory": 1}
    assert spark.table(f"{database}.old_sales").count() == 5


def test_archived_folders_outlive_their_version(spark, tmp_path, database):
    warehouse = Warehouse(spark, database, str(tmp_path / "db"), keep=1)
    warehouse.write_sales(star(spark, [{"sale_date": D("2023-05-05")}, {}], first="2023-01-01").sales)
    warehouse.archive_year(2023, "old_sales")
    warehouse.write_sales(star(spark, [{}]).sales)
    gone = warehouse.vacuum()
    assert len(gone) == 1 and "sale_year=2024" in gone[0]
    assert spark.table(f"{database}.old_sales").count() == 1


def test_digests_tell_contents_not_files(spark, tmp_path):
    one = write(tmp_path / "one.csv", SALES_HEADER + "a,b\nc,d\nc,d\n")
    parts = tmp_path / "parts"
    parts.mkdir()
    write(parts / "x.csv", SALES_HEADER + "c,d\n")
    write(parts / "y.csv", SALES_HEADER + "c,d\na,b\n")
    less = write(tmp_path / "less.csv", SALES_HEADER + "a,b\nc,d\n")
    none = write(tmp_path / "none.csv", SALES_HEADER)
    found = content_digests(spark, "sales", [one, str(parts), less, none]).orderBy("place").collect()
    assert found[0]["digest"] == found[1]["digest"] and len({r["digest"] for r in found}) == 3
    assert [r["lines"] for r in found] == [3, 3, 2, 0]


@pytest.mark.parametrize("numbers, text", [([], ""), ([3], "3"), ([1, 2, 3, 7], "1-3,7"), ([5, 4, 4, 9, 10], "4-5,9-10")])
def test_ranges(numbers, text):
    assert as_ranges(numbers) == text and from_ranges(text) == set(numbers)
