"""What loads and writes leave on disk, and hold there while they run."""

import time

import pytest

from tests.helpers import D, rows, star
from tests.test_storage import INVENTORY_HEADER, PRODUCTS_HEADER, SALES_HEADER, STORES_HEADER, write
from tillscope.operators import quality
from tillscope.operators.calendar import calendar
from tillscope.plans import load
from tillscope.plans.load import SourceFiles, load_star
from tillscope.sources import csv
from tillscope.sources import warehouse as stored
from tillscope.sources.shared import CLEANUP_SETTING
from tillscope.sources.warehouse import Warehouse

DAYS = ("2023-01-31", "2023-02-01", "2023-02-28", "2023-03-01", "2024-06-05", "2031-01-01")


def lines(*days):
    return [{"sale_id": i, "sale_date": D(d) if d else None} for i, d in enumerate(days)]


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for f in (files.apply(i).getName() for i in range(files.size())) if f.startswith("shuffle_")}


def test_a_write_leaves_no_shuffle_files(spark, tmp_path, database):
    warehouse = Warehouse(spark, database, str(tmp_path / "db"))
    df = star(spark, lines(*DAYS), first="2023-01-01").sales.repartition(3, "sale_date")
    before, setting = shuffle_files(spark), spark.conf.get(CLEANUP_SETTING)
    warehouse.write_fact("sales", df, 1)
    for _ in range(50):  # files are deleted beside the driver's work
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    assert not left, left
    assert spark.conf.get(CLEANUP_SETTING) == setting


def test_a_fact_is_written_a_range_of_months_at_a_time(spark, tmp_path, database, monkeypatch):
    monkeypatch.setattr(stored, "RANGE_ROWS", 2)
    warehouse = Warehouse(spark, database, str(tmp_path / "db"))
    df = star(spark, lines(*DAYS, None, None), first="2023-01-01").sales
    ranges = [sorted(rows(part, "sale_id")) for part in warehouse._ranges(df, "sales")]
    assert ranges == [[0, 1, 2, 6, 7], [3, 4], [5]]
    warehouse.write_sales(df)
    back = warehouse.table("sales")
    assert sorted(map(repr, rows(back, *df.columns))) == sorted(map(repr, rows(df, *df.columns)))
    assert all(f.endswith(".zstd.parquet") for f in back.inputFiles())
    assert {p.name for p in (tmp_path / "db" / "files").iterdir()} == {p["written_as"] for p in warehouse.parts("sales")}
    again = Warehouse(spark, f"{database}_b", str(tmp_path / "b"), ticket_buckets=2)
    again.write_sales(df)
    again.put_fact("sales", df, "append")
    assert again.table("sales").count() == 2 * df.count()


def test_few_ranges_whatever_the_rows(spark, monkeypatch, tmp_path, database):
    monkeypatch.setattr(stored, "RANGE_ROWS", 1)
    warehouse = Warehouse(spark, database, str(tmp_path / "db"))
    months = [f"{y}-{m:02d}-01" for y in (2023, 2024) for m in range(1, 13)]
    parts = warehouse._ranges(star(spark, lines(*months), first="2023-01-01").sales, "sales")
    assert [part.count() for part in parts] == [6] * 4
    assert len(warehouse._ranges(star(spark, lines(None)).sales, "sales")) == 1


def files(tmp_path):
    """Faults in all tables: a blank name, unknown products, snapshots given twice."""
    sales = "".join(f"{p},1,2024-0{m},10:00:00,t{p},1,9.90,0,in-store\n" for p in (1, 2, 7, 8, 9) for m in ("1-05", "3-05"))
    stock = [f"{p},1,2024-0{m}-01,10,10,0,0,5.00\n" for p in (1, 2, 9) for m in (1, 2, 3)]
    return SourceFiles(
        write(tmp_path / "p.csv", PRODUCTS_HEADER + "1,S1,A,M,C,s,1\n2,S2,B,M,C,s,1\n3,S3, ,M,C,s,1\n"),
        write(tmp_path / "s.csv", STORES_HEADER + "1,T1,One,C,Super,N,X,Y,100,2020-01-01\n"),
        [write(tmp_path / "v.csv", SALES_HEADER + sales)],
        write(tmp_path / "i.csv", INVENTORY_HEADER + "".join(stock + stock[:2])),
    )


DAYS_2024 = (D("2024-01-01"), D("2024-12-31"))
REJECTED = [("inventory", "DQ19")] * 3 + [("inventory", "DQ4")] * 4 + [("products", "DQ15")] + [("sales", "DQ19")] * 6


def reasons(rejected):
    return sorted((r["table_name"], rule) for r in rejected.collect() for rule in r["broken_rules"])


def test_work_tables_go_when_their_rows_are_written(spark, tmp_path, database):
    seen = {}

    class Watched(Warehouse):
        def write_fact(self, table, *args, **kwargs):
            seen[table] = [*self._named("staging_*"), *self._named("checked_*")]
            return super().write_fact(table, *args, **kwargs)

    warehouse = Watched(spark, database, str(tmp_path / "db"))
    assert reasons(load_star(files(tmp_path), calendar(spark, *DAYS_2024), warehouse)) == REJECTED
    assert seen == {"sales": ["checked_sales"], "inventory": ["checked_inventory"]}
    assert not warehouse._named("staging_*") and not warehouse._named("checked_*")


def test_rows_are_checked_a_portion_at_a_time(spark, tmp_path, database, monkeypatch):
    monkeypatch.setattr(load, "PORTION_ROWS", 1)
    monkeypatch.setattr(stored, "RANGE_ROWS", 1)
    monkeypatch.setattr(quality, "FEW_KEYS", 1)  # unknown products are stored and joined
    warehouse = Warehouse(spark, database, str(tmp_path / "db"))
    rejected = load_star(files(tmp_path), calendar(spark, *DAYS_2024), warehouse)
    assert reasons(rejected) == REJECTED
    sold, stock = warehouse.table("sales"), warehouse.table("inventory")
    assert sorted(rows(sold, "product_id", "sale_date")) == [(p, D(f"2024-0{m}-05")) for p in (1, 2) for m in (1, 3)]
    assert sorted(rows(stock, "product_id", "snapshot_date")) == [
        (1, D("2024-03-01")), *((2, D(f"2024-0{m}-01")) for m in (1, 2, 3))]
    assert len(set(rows(sold, "sale_id"))) == 4 and warehouse.last_key("sales") >= max(rows(sold, "sale_id"))
    assert {p.name for p in (tmp_path / "db" / "files").iterdir()} == {
        p["written_as"] for t in ("sales", "inventory") for p in warehouse.parts(t)
    } | {warehouse.properties(t)["stored_in"] for t in ("products", "stores", "calendar")}


def test_portions_keep_a_key_together(spark):
    df = spark.range(60).selectExpr("id % 20 AS product_id", "1L AS store_id", "DATE '2024-01-01' AS snapshot_date")
    parts = [rows(part, "product_id") for part in load._portions("inventory", df, 10**9, load.FACT_KEYS["inventory"])]
    assert len(parts) == load.MOST_PORTIONS and sorted(p for part in parts for p in part) == sorted(list(range(20)) * 3)
    assert sum(len(set(part)) for part in parts) == 20
    two = {"DQ1": ("product_id",), "DQ2": ("sku",)}
    assert len(load._portions("products", df, 10**9, two)) == 1 and len(load._portions("inventory", df, 60, {})) == 1


def test_a_load_that_breaks_off_keeps_its_number(spark, tmp_path, database, monkeypatch):
    warehouse = Warehouse(spark, database, str(tmp_path / "db"))
    source, days = files(tmp_path), calendar(spark, *DAYS_2024)

    def fail(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(Warehouse, "write_fact", fail)
        with pytest.raises(RuntimeError):
            load_star(source, days, warehouse)
    assert reasons(load_star(source, days, warehouse)) == REJECTED == reasons(warehouse.rejected())
    assert warehouse.loads("sales") == {2}


def test_compressed_exchange_files_give_the_same_rows(spark, tmp_path):
    df = star(spark, lines(*DAYS, None), first="2023-01-01").sales.repartition(3, "sale_date")
    for name, how in (("plain", {}), ("packed", {"compression": "gzip"})):
        csv.write_csv(df, "sales", str(tmp_path / name), **how)
    plain, packed = (csv.read_sales(spark, [str(tmp_path / name)]) for name in ("plain", "packed"))
    assert all(f.endswith(".csv.gz") for f in packed.inputFiles()) and all(f.endswith(".csv") for f in plain.inputFiles())
    assert sorted(map(repr, packed.collect())) == sorted(map(repr, plain.collect()))
    digests = csv.content_digests(spark, "sales", [str(tmp_path / "plain"), str(tmp_path / "packed")])
    assert len(set(rows(digests, "digest"))) == 1
