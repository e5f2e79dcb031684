"""Summaries and state tables that follow appends, and layouts that prune."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tests.helpers import D, SALE, SNAPSHOT, STORE, frame, rows, star
from tillscope.functions.periods import snapshots_between, sold_between
from tillscope.plans import inventory, kpi, metrics, products, served, state, summary, tickets
from tillscope.sources.shared import materialized, scratch
from tillscope.sources.warehouse import Warehouse

AS_OF = D("2024-06-30")
MONTHLY = [name for name, s in summary.SUMMARIES.items() if s.months]


def sale_rows(n, first, days, seed):
    rng = random.Random(seed)
    return [
        {"sale_id": seed * 1000 + k, "product_id": rng.randint(1, 4), "store_id": rng.randint(1, 2), "ticket_id": f"t{rng.randint(0, n)}",
         "sale_date": first + timedelta(rng.randrange(days)), "quantity": rng.randint(1, 5), "unit_price": rng.randint(1, 90)}
        for k in range(n)
    ]


def snapshot_rows(n, first, days, seed):
    rng, seen = random.Random(seed), {}
    for k in range(n):
        row = {"inventory_id": seed * 1000 + k, "product_id": rng.randint(1, 4), "store_id": rng.randint(1, 2),
               "snapshot_date": first + timedelta(rng.randrange(days)), "final_stock": rng.randint(0, 30),
               "unit_cost": rng.choice([None, 2, 3, 4])}
        seen[row["product_id"], row["store_id"], row["snapshot_date"]] = row
    return list(seen.values())


PRODUCTS = [{"product_id": k, "sku": f"S{k}", "category": f"C{k % 2}"} for k in range(1, 5)]
STORES = [{"store_id": k, "store_code": f"T{k}", "region": f"R{k}"} for k in (1, 2)]
OLD = (sale_rows(80, D("2023-11-01"), 150, 1), snapshot_rows(60, D("2022-12-15"), 400, 1))
NEW = (sale_rows(20, D("2024-05-03"), 20, 2), snapshot_rows(20, D("2024-02-01"), 90, 2))


def whole(spark, sales, snapshots):
    return star(spark, sales, snapshots, PRODUCTS, STORES, first="2022-01-01")


@pytest.fixture
def stored(spark, tmp_path, database):
    warehouse = Warehouse(spark, database, str(tmp_path / "db"))
    warehouse.write_star(whole(spark, *OLD))
    return warehouse, summary.SummaryStore(spark, database + "_s", str(tmp_path / "summaries"))


def add(warehouse, spark, sales=(), snapshots=()):
    if sales:
        warehouse.put_fact("sales", frame(spark, "sales", SALE, sales), "append")
    if snapshots:
        warehouse.put_fact("inventory", frame(spark, "inventory", SNAPSHOT, snapshots), "append")


def same(a, b):
    return sorted(map(repr, a.collect())) == sorted(map(repr, b.select(*a.columns).collect()))


def test_an_append_rewrites_its_month_only(spark, stored):
    warehouse, store = stored
    summary.refresh(store, warehouse.star(), AS_OF, MONTHLY)
    before = {name: set(store.parts(name)) for name in MONTHLY}
    add(warehouse, spark, NEW[0])
    summary.refresh(store, warehouse.star(), AS_OF, MONTHLY)
    everything = whole(spark, OLD[0] + NEW[0], OLD[1])
    for name in MONTHLY:
        new = set(store.parts(name)) - before[name]
        assert {summary.SUMMARIES[name].months.of_part(p) for p in new} == {202405}, name
        want = summary.SUMMARIES[name]
        if not want.needs:
            assert same(store.read(name), want.build(everything, store, AS_OF)), name
    want = summary.build_product_performance(everything)
    assert same(store.read("product_performance"), want)
    assert same(store.read("product_velocity"), summary.build_product_performance(everything, velocity=True))


def test_an_append_into_a_stored_month_rebuilds_it(spark, stored):
    warehouse, store = stored
    summary.refresh(store, warehouse.star(), AS_OF, ["daily_sales"])
    before = set(store.parts("daily_sales"))
    more = sale_rows(10, D("2024-01-10"), 5, 3)
    add(warehouse, spark, more)
    summary.refresh(store, warehouse.star(), AS_OF, ["daily_sales"])
    changed = set(store.parts("daily_sales")) ^ before
    assert {int(p["year"]) * 100 + int(p["month"]) for p in changed} == {202401}
    assert same(store.read("daily_sales"), summary.build_daily_summary(whole(spark, OLD[0] + more, OLD[1])))


def test_months_that_go_leave_and_dimensions_that_change_rebuild(spark, stored):
    warehouse, store = stored
    summary.refresh(store, warehouse.star(), AS_OF, ["daily_sales"])
    warehouse.archive_year(2023, "old")
    summary.refresh(store, warehouse.star(), AS_OF, ["daily_sales"])
    kept = set(store.parts("daily_sales"))
    assert {p["year"] for p in kept} == {"2024"}
    moved = frame(spark, "stores", {**STORE, "region": "elsewhere"}, [{"store_id": 1}, {"store_id": 2}])
    warehouse.write_table("stores", moved)
    summary.refresh(store, warehouse.star(), AS_OF, ["daily_sales"])
    assert not kept & set(store.parts("daily_sales"))
    assert set(rows(store.read("daily_sales"), "region")) == {"elsewhere"}


def test_a_refresh_without_changes_writes_nothing(spark, stored, tmp_path):
    warehouse, store = stored
    summary.refresh(store, warehouse.star(), AS_OF, ["daily_sales"])
    folders = set((tmp_path / "summaries" / "files").iterdir())
    summary.refresh(store, warehouse.star(), AS_OF, ["daily_sales"])
    assert set((tmp_path / "summaries" / "files").iterdir()) == folders and store.version("daily_sales") == 2


def test_refreshes_leave_no_intermediate_tables(spark, stored, tmp_path, monkeypatch):
    warehouse, store = stored
    monkeypatch.setattr("tillscope.sources.shared.shared_folder", lambda _: str(tmp_path / "shared"))
    summary.refresh(store, warehouse.star(), AS_OF, ["product_months", "product_performance"])
    assert not (tmp_path / "shared").exists() or not list((tmp_path / "shared").iterdir())
    with scratch(spark) as folder:
        kept = materialized(spark.range(3))
        assert kept.count() == 3 and all(folder in f for f in kept.inputFiles())
    assert not list((tmp_path / "shared").iterdir())


def test_dashboard_reads_are_a_scan_and_a_filter(spark, stored):
    warehouse, store = stored
    current = warehouse.star()
    summary.refresh(store, current, AS_OF, ["regional_performance", "daily_sales", *summary.group_names("inventory")])
    served.refresh(store, D("2024-03-20"), min_net=1)
    regional = store.read("regional_performance")
    category = rows(regional.limit(1), "category")[0]
    for fast, plain in (
        (served.regional_ranking(store, 2), products.regional_ranking_fast(regional, D("2024-03-20"), 1, 2)),
        (served.top_in_category_region(store, category, "R1", 1),
         products.top_in_category_region(regional, D("2024-03-20"), category, "R1", 1)),
        (served.critical_alerts(store), inventory.critical_alerts(store.read("inventory_alerts"))),
        (served.daily_kpis(store, D("2024-03-20"), "C"), summary.daily_kpis(store.read("daily_sales"), D("2024-03-20"), "C")),
    ):
        assert same(plain, fast)
        text = fast._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in text and "Sort" not in text and "Aggregate" not in text


def test_readers_keep_the_months_they_opened(spark, stored):
    warehouse, store = stored
    summary.refresh(store, warehouse.star(), AS_OF, ["daily_sales"])
    opened = store.read("daily_sales")
    want = opened.count()
    add(warehouse, spark, sale_rows(10, D("2024-01-10"), 5, 3))
    for _ in range(3):
        summary.refresh(store, warehouse.star(), AS_OF, ["daily_sales"])
    assert opened.count() == want


def test_an_empty_fact_gives_empty_summaries(spark, tmp_path, database):
    warehouse = Warehouse(spark, database, str(tmp_path / "db"))
    warehouse.write_star(star(spark))
    store = summary.SummaryStore(spark, database + "_s", str(tmp_path / "summaries"))
    summary.refresh_all(store, warehouse.star(), AS_OF)
    assert {store.read(name).count() for name in summary.SUMMARIES} == {0}
    assert state.refresh_positions(store, warehouse.star()).count() == 0
    assert state.refresh_costs(store, warehouse.star()).count() == 0


def test_positions_follow_new_snapshots_without_reading_old_ones(spark, stored, monkeypatch):
    warehouse, store = stored
    state.refresh_positions(store, warehouse.star(), buckets=2)
    add(warehouse, spark, (), NEW[1])
    after = warehouse.star()
    assert state.current_positions(store, after) is None
    monkeypatch.setattr(type(after), "inventory", property(lambda self: pytest.fail("all snapshots were read")))
    got = state.refresh_positions(store, after, buckets=2)
    monkeypatch.undo()
    latest = {}
    for r in sorted(OLD[1] + NEW[1], key=lambda r: r["snapshot_date"]):
        latest[r["product_id"], r["store_id"]] = (r["snapshot_date"], r["final_stock"])
    assert {(r.product_id, r.store_id): (r.snapshot_date, r.final_stock) for r in got.collect()} == latest
    full = inventory.inventory_alerts_full(after, AS_OF, lookback_days=200, min_days=1)
    fast = inventory.inventory_alerts_full(after, AS_OF, lookback_days=200, min_days=1, positions=got)
    assert same(full, fast)
    text = fast._jdf.queryExecution().executedPlan().toString()
    assert "snapshot_month" not in text and "opening_stock" not in text
    assert same(summary.build_latest_inventory(after, AS_OF), summary.build_latest_inventory(after, AS_OF, positions=got))
    again = store.version(state.POSITIONS)
    state.refresh_positions(store, after)
    assert store.version(state.POSITIONS) == again


def test_replaced_snapshots_rebuild_the_positions(spark, stored):
    warehouse, store = stored
    state.refresh_positions(store, warehouse.star())
    warehouse.write_table("inventory", frame(spark, "inventory", SNAPSHOT, [{"final_stock": 3}]))
    assert rows(state.refresh_positions(store, warehouse.star()), "final_stock") == [3]


def test_cost_intervals_equal_the_last_cost_so_far(spark, stored):
    warehouse, store = stored
    state.refresh_costs(store, warehouse.star())
    before = set(store.parts(state.COSTS))
    add(warehouse, spark, NEW[0], NEW[1])
    current = warehouse.star()
    costs = state.refresh_costs(store, current)
    assert {p["cost_year"] for p in set(store.parts(state.COSTS)) & before} == {"2022", "2023"}
    for start, end in ((D("2023-01-01"), D("2023-12-31")), (D("2024-01-01"), AS_OF), (D("2022-01-01"), AS_OF)):
        assert same(metrics.margin(current, start, end), metrics.margin(current, start, end, costs))
    assert state.current_costs(store, current) is not None
    for r in costs.collect():
        assert r.valid_from <= r.valid_to and r.valid_from.year == r.valid_to.year == r.cost_year
    plan = metrics.margin(current, D("2023-01-01"), D("2023-12-31"), costs)
    assert len({f.split("cost_year=")[1][:4] for f in plan.inputFiles() if "cost_year=" in f}) <= 3
    text = plan._jdf.queryExecution().executedPlan().toString()
    scan = next(part for part in text.split("FileScan parquet ")[1:] if "unit_costs" in part[:200])
    assert "cost_year" in scan.split("PartitionFilters: [")[1].split("]")[0] and "snapshot_date" not in text


def test_a_year_of_sales_without_snapshots_carries_costs(spark, stored):
    warehouse, store = stored
    state.refresh_costs(store, warehouse.star())
    later = [{"sale_id": 9, "sale_date": D("2025-03-01"), "product_id": 1}]
    warehouse.write_table("calendar", star(spark, first="2022-01-01", last="2025-12-31").calendar)
    add(warehouse, spark, later)
    costs = state.refresh_costs(store, warehouse.star())
    spans = (D("2025-01-01"), D("2025-12-31"))
    assert same(metrics.margin(warehouse.star(), *spans), metrics.margin(warehouse.star(), *spans, costs))
    assert costs.where("cost_year = 2025").count() > 0


@pytest.mark.parametrize("grain", ["month", "day"])
def test_ranges_of_dates_open_their_folders_only(spark, tmp_path, database, grain):
    warehouse = Warehouse(spark, database, str(tmp_path / "db"), grain=grain)
    warehouse.write_star(whole(spark, *OLD))
    stored_star = warehouse.star()
    day = D("2024-01-10")

    def listed(df):
        scans = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        files = [f for k in range(scans.size()) for f in scans.apply(k).relation().location().inputFiles() if "/files/" in f]
        return files

    one = listed(sold_between(stored_star.sales, day, day))
    assert one and all("sale_month=202401" in f for f in one)
    if grain == "day":
        assert all("sale_date=2024-01-10" in f for f in one)
    everything = listed(stored_star.sales)
    assert len(one) < len(everything)
    fresh = listed(snapshots_between(stored_star.inventory, D("2023-12-20"), None))
    assert fresh and all(f.split("snapshot_month=")[1][:6] >= "202312" for f in fresh)
    for plan in (
        inventory.stock_alerts(stored_star, D("2024-01-15")),
        kpi.inventory_health(stored_star, D("2024-01-15")),
        summary.build_latest_inventory(stored_star, D("2024-01-15"), days=30),
    ):
        text = plan._jdf.queryExecution().executedPlan().toString()
        scans = [part for part in text.split("FileScan parquet ")[1:] if "final_stock" in part]
        assert scans and all("snapshot_month" in s.split("PartitionFilters: [")[1].split("]")[0] for s in scans)


def test_files_of_a_month_hold_ranges_of_dates(spark, tmp_path, database):
    warehouse = Warehouse(spark, database, str(tmp_path / "db"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        warehouse.write_sales(frame(spark, "sales", SALE, sale_rows(400, D("2024-03-01"), 31, 5)))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spans = warehouse.table("sales").groupBy(F.input_file_name()).agg(F.min("sale_date").alias("a"), F.max("sale_date").alias("b"))
    found = sorted((r.a, r.b) for r in spans.collect())
    assert len(found) == 4 and all(x[1] <= y[0] for x, y in zip(found, found[1:]))


def test_one_hot_date_spreads_over_tasks(spark, tmp_path, database):
    warehouse = Warehouse(spark, database, str(tmp_path / "db"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        hot = [{"sale_id": k, "ticket_id": f"t{k}"} for k in range(300)] + sale_rows(100, D("2024-03-01"), 31, 5)
        warehouse.write_sales(frame(spark, "sales", SALE, hot))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = rows(warehouse.table("sales").groupBy(F.input_file_name()).agg(F.count("*").alias("n")), "n")
    assert max(sizes) < 200


def test_ticket_buckets_group_tickets_without_an_exchange(spark, tmp_path, database):
    warehouse = Warehouse(spark, database, str(tmp_path / "db"), ticket_buckets=4)
    lines = OLD[0] + [{"sale_id": 5000 + k, "ticket_id": None, "sale_date": D("2024-01-02")} for k in range(40)]
    warehouse.write_star(whole(spark, lines, OLD[1]))
    add(warehouse, spark, NEW[0])
    assert warehouse.table("sales").count() == len(lines) + len(NEW[0])
    range_of = (D("2023-12-01"), AS_OF)
    plain = whole(spark, lines + NEW[0], OLD[1])
    bucketed = warehouse.star()
    grouped = tickets._per_ticket(tickets._ticket_lines(bucketed, *range_of), "store_id")
    text = grouped._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in text and "Exchange" not in text
    assert same(tickets.weekly_ticket_by_format(plain, *range_of), tickets.weekly_ticket_by_format(bucketed, *range_of))
    assert same(tickets.monthly_ticket_by_region(plain, *range_of), tickets.monthly_ticket_by_region(bucketed, *range_of))
