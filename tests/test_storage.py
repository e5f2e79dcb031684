"""Files, stored tables, load, refresh."""

import tempfile
from decimal import Decimal
from types import SimpleNamespace

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.helpers import D, SALE, frame, rows, star
from tillscope.functions.periods import sold_between
from tillscope.operators.calendar import calendar
from tillscope.operators.validate import profile_files, table_sizes
from tillscope.plans import products, summary
from tillscope.plans.load import SourceFiles, load_star
from tillscope.sources import csv
from tillscope.sources.shared import shared_folder
from tillscope.sources.warehouse import Warehouse

AS_OF = D("2024-06-30")


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


PRODUCTS_HEADER = "id_producto,sku,nombre_producto,marca,categoria,subcategoria,precio_sugerido\n"
STORES_HEADER = "id_tienda,codigo_tienda,nombre_tienda,cadena,formato,region,ciudad,estado,superficie_m2,fecha_apertura\n"
SALES_HEADER = "id_producto,id_tienda,fecha,hora,ticket_id,cantidad,precio_unitario,descuento_pct,canal\n"
INVENTORY_HEADER = "id_producto,id_tienda,fecha,stock_inicial,stock_final,entradas,salidas,costo_unitario\n"


def test_csv_quotes_nulls_and_accents(spark, tmp_path):
    path = write(tmp_path / "p.csv", PRODUCTS_HEADER + '1,S1,"Jamón ""x"", kg",M,C,,9.90\n2,S2,"",M,C,sub,\n')
    got = csv.read_products(spark, path).orderBy("product_id")
    assert rows(got, "product_name", "subcategory", "list_price") == [
        ('Jamón "x", kg', None, Decimal("9.90")), ("", "sub", None)
    ]


def test_csv_with_a_wrong_header_or_value_stops(spark, tmp_path):
    header = PRODUCTS_HEADER.replace("sku,nombre_producto", "nombre_producto,sku")
    swapped = write(tmp_path / "a.csv", header + "1,a,b,c,d,e,1\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        csv.read_products(spark, swapped).collect()
    broken = write(tmp_path / "b.csv", PRODUCTS_HEADER + "one,S1,n,m,c,s,1\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        csv.read_products(spark, broken).collect()


def test_csv_round_trip(spark, tmp_path):
    s = star(spark, [{"ticket_id": None}, {"sale_date": D("2023-02-01"), "channel": " a,b "}], first="2023-01-01")
    csv.write_csv(s.sales, "sales", str(tmp_path / "out"))
    back = csv.read_sales(spark, [str(tmp_path / "out")])
    columns = ("product_id", "sale_date", "ticket_id", "channel", "unit_price")
    assert sorted(map(repr, rows(back, *columns))) == sorted(map(repr, rows(s.sales, *columns)))


def test_defaults_fill_missing_columns_only(spark):
    df = frame(spark, "sales", SALE, [{"discount_pct": None}]).drop("tax_pct", "channel", "created_at", "seller_id")
    got = csv.with_defaults(df, "sales").first()
    assert (got["discount_pct"], got["tax_pct"], got["channel"]) == (None, 16, "in-store")
    assert got["created_at"] is not None
    assert got.asDict()["seller_id"] is None
    keyless = frame(spark, "sales", SALE, [{}]).drop("sale_id")
    assert "sale_id" not in csv.with_defaults(keyless, "sales").columns


def test_sales_are_stored_by_year_and_pruned(spark, tmp_path, database):
    lines = [{"sale_date": D(d)} for d in ("2022-12-31", "2023-01-01", "2024-06-05", "2031-01-01")]
    s = star(spark, lines, first="2022-01-01")
    warehouse = Warehouse(spark, database, str(tmp_path / "db"))
    warehouse.write_sales(s.sales)
    folders = sorted(p.name for p in (tmp_path / "db" / "files").glob("*/sale_year=*"))
    assert folders == ["sale_year=2022", "sale_year=2023", "sale_year=2024", "sale_year=2031"]
    ranged = sold_between(warehouse.table("sales"), D("2022-12-31"), D("2023-12-31"))
    plan = ranged._jdf.queryExecution().executedPlan().toString()
    assert "sale_year" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert ranged.count() == 2


def test_descriptions_reach_the_catalog(spark, tmp_path, database):
    warehouse = Warehouse(spark, database, str(tmp_path / "db"))
    warehouse.write_table("products", star(spark).products)
    notes = {r["col_name"]: r["comment"] for r in warehouse.descriptions("products").collect()}
    assert notes["sku"] == "Stock keeping unit, unique"


def test_clear_keeps_the_calendar_and_reload_works(spark, tmp_path, database):
    s = star(spark, [{}], [{}])
    warehouse = Warehouse(spark, database, str(tmp_path / "db"))
    warehouse.write_star(s)
    assert rows(products.top_products(warehouse.star(), 2024, 2), "units") == [1]
    warehouse.clear()
    assert {t: df.count() for t, df in warehouse.star().tables().items()} == {
        "products": 0, "stores": 0, "calendar": 366, "sales": 0, "inventory": 0
    }
    warehouse.write_star(s)
    assert warehouse.table("sales").count() == 1


def test_archive_moves_years_and_can_be_repeated(spark, tmp_path, database):
    s = star(spark, [{"sale_date": D("2022-05-05")}, {"sale_date": D("2023-05-05")}, {}], first="2022-01-01")
    warehouse = Warehouse(spark, database, str(tmp_path / "db"))
    archive = f"{database}.old_sales"
    warehouse.write_sales(s.sales)
    assert warehouse.archive_year(2023, archive) == 1
    assert sorted(rows(warehouse.table("sales"), "sale_year")) == [2022, 2024]
    # As if the run had broken off before it removed the year.
    warehouse.write_sales(s.sales.filter("year(sale_date) = 2023"), mode="append")
    assert warehouse.archive_year(2023, archive) == 1
    assert warehouse.archive_year(2022, archive) == 1
    assert rows(warehouse.table("sales"), "sale_year") == [2024]
    assert sorted(rows(spark.table(archive), "sale_year")) == [2022, 2023]


def test_load_rejects_with_reasons_and_keeps_the_rest(spark, tmp_path, database):
    files = SourceFiles(
        products=write(tmp_path / "p.csv", PRODUCTS_HEADER
                       + "1,S1,Milk,M,C,s,9.90\n2,S2, ,M,C,s,1\n3,S3,A,M,C,s,1\n3,S4,B,M,C,s,1\nx,S5,C,M,C,s,1\n"),
        stores=write(tmp_path / "s.csv", STORES_HEADER + "1,T1,One,C,Super,N,X,Y,100,2020-01-01\n"),
        sales=[
            write(tmp_path / "v1.csv", SALES_HEADER + "1,1,2024-01-05,10:00:00,t1,2,9.90,,in-store\n"
                  "2,1,2024-01-05,10:00:00,t1,1,1.00,0,in-store\n"),
            write(tmp_path / "v2.csv", SALES_HEADER + "1,1,2025-01-05,10:00:00,t2,1,9.90,0,online\n"
                  "1,1,2024-02-05,10:00:00,t3,0,9.90,0,fax\n"),
        ],
        inventory=write(tmp_path / "i.csv", INVENTORY_HEADER
                        + "1,1,2024-01-01,10,8,0,2,5.00\n1,1,2024-02-01,10,9,0,2,5.00\n"),
    )
    warehouse = Warehouse(spark, database, str(tmp_path / "db"))
    rejected = load_star(files, calendar(spark, D("2024-01-01"), D("2024-12-31")), warehouse)
    reasons = sorted((r["table_name"], sorted(r["broken_rules"])) for r in rejected.collect())
    assert reasons == [
        ("inventory", ["DQ18"]),
        ("products", ["DQ1"]), ("products", ["DQ1"]), ("products", ["DQ15"]), ("products", ["PARSE"]),
        ("sales", ["DQ17", "DQ8"]), ("sales", ["DQ19"]), ("sales", ["DQ20"]),
    ]
    stored = warehouse.star()
    assert rows(stored.products, "product_id", "is_active") == [(1, True)]
    assert rows(stored.sales, "ticket_id", "tax_pct", "discount_pct") == [("t1", 16, None)]
    assert stored.sales.filter("sale_id > 0").count() == 1
    assert rows(stored.inventory, "stock_value") == [40]


def test_refresh_swaps_versions_and_old_readers_stay(spark, tmp_path, database):
    store = summary.SummaryStore(spark, database, str(tmp_path / "db"))
    day = lambda n: star(spark, [{"ticket_id": f"t{i}"} for i in range(n)])
    summary.refresh(store, day(1), AS_OF, ["daily_sales"])
    reader = store.read("daily_sales")
    status = summary.refresh(store, day(3), AS_OF, ["daily_sales"]).first()
    assert (status["name"], status["rows"], status["newest_data"], status["days_behind"]) == (
        "daily_sales", 1, D("2024-06-05"), 25)
    assert status["refreshed_at"]
    assert rows(reader, "tickets") == [1]
    assert rows(store.read("daily_sales"), "tickets") == [3]
    summary.refresh(store, day(4), AS_OF, ["daily_sales"])
    assert sorted(store._tables("daily_sales")) == [1, 2, 3]
    for n in (5, 6):
        summary.refresh(store, day(n), AS_OF, ["daily_sales"])
    assert sorted(store._tables("daily_sales")) == [2, 3, 4, 5]
    assert rows(summary.list_summaries(store), "name", "version") == [("daily_sales", 5)]
    store.drop("daily_sales")
    assert store.names() == [] and store._tables("daily_sales") == {}


def test_refresh_after_an_attempt_that_broke_off(spark, tmp_path, database):
    store = summary.SummaryStore(spark, database, str(tmp_path / "db"))
    one = star(spark, [{}])
    summary.refresh(store, one, AS_OF, ["daily_sales"])
    left = tmp_path / "db" / "files" / "abc"
    left.mkdir()
    (left / "part-0.parquet").write_bytes(b"broken")
    written = store.write("daily_sales", summary.build_daily_summary(one), ("year", "month"))
    (tmp_path / "db" / "other").mkdir()
    reader = store.read("daily_sales")
    for _ in range(3):
        summary.refresh(store, one, AS_OF, ["daily_sales"])
    assert not left.exists() and (tmp_path / "db" / "other").exists()
    assert not spark.catalog.tableExists(written.table)
    assert not (tmp_path / "db" / "files" / written.token).exists()
    assert rows(reader, "tickets") == [1]


def test_refresh_runs_in_dependency_order(spark, tmp_path, database):
    store = summary.SummaryStore(spark, database, str(tmp_path / "db"))
    s = star(spark, [{"sale_date": D(f"2024-06-{d}")} for d in (25, 26, 27)], [{"snapshot_date": D("2024-06-28")}])
    with pytest.raises(ValueError, match="not published"):
        summary.refresh(store, s, AS_OF, ["inventory_alerts"])
    names = ["inventory_alerts", "recent_sales", "latest_inventory"]
    done = summary.refresh(store, s, AS_OF, names)
    assert rows(done, "name") == ["latest_inventory", "recent_sales", "inventory_alerts"]
    assert rows(store.read("inventory_alerts"), "alert", "avg_daily_sales") == [("NORMAL", 1.0)]
    with pytest.raises(ValueError, match="unknown"):
        summary.refresh(store, s, AS_OF, ["no_such"])


def test_refresh_all_and_stats(spark, tmp_path, database):
    store = summary.SummaryStore(spark, database, str(tmp_path / "db"))
    s = star(spark, [{"sale_date": D(f"2024-06-{d}")} for d in (25, 26, 27)], [{"snapshot_date": D("2024-06-28")}])
    summary.refresh_all(store, s, AS_OF)
    stats = {r["name"]: r for r in summary.summary_stats(store, AS_OF).collect()}
    assert set(stats) == set(summary.SUMMARIES)
    assert stats["daily_sales"]["days_behind"] == 3
    assert stats["store_performance"]["newest_data"] is None
    fast = products.regional_ranking_fast(store.read("regional_performance"), AS_OF, min_net=1)
    full = products.regional_ranking(s, AS_OF, min_net=1)
    assert rows(fast, "region", "product_id", "net_sales") == rows(full, "region", "product_id", "net_sales")
    kpis = summary.daily_kpis(store.read("daily_sales"), AS_OF, "C")
    assert rows(kpis, "sale_date", "net_per_ticket")[0] == (D("2024-06-27"), 10.0)


def test_sizes_and_profile(spark, tmp_path):
    for name, n in (("small", 10), ("large", 5000)):
        spark.range(n).withColumn("x", F.rand(1)).coalesce(1).write.parquet(str(tmp_path / name))
    sizes = table_sizes(spark, {n: str(tmp_path / n) for n in ("small", "large")}).collect()
    assert [r["table_name"] for r in sizes] == ["large", "small"]
    profile = profile_files(spark.read.parquet(str(tmp_path / "large"))).collect()
    assert [r["records"] for r in profile] == [5000]


def test_shared_folder_is_the_one_the_session_names():
    def session(master, conf=None, found=None):
        place = SimpleNamespace(isDefined=lambda: found is not None, get=lambda: found)
        jsc = SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: place))
        return SimpleNamespace(conf=conf or {}, sparkContext=SimpleNamespace(_jsc=jsc, master=master))

    assert shared_folder(session("yarn", {"spark.checkpoint.dir": "/shared/place/"})) == "/shared/place"
    assert shared_folder(session("yarn", found="/of/context")) == "/of/context"
    assert shared_folder(session("local[4]")).startswith(tempfile.gettempdir())
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session("yarn"))
