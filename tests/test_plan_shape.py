"""Physical plans: what is pruned, broadcast, and never done."""

from datetime import date

import pytest

from bench import headline_queries
from checks import registry as r
from tests.helpers import star
from tillscope.plans import inventory, products, sales, summary, tickets
from tillscope.sources.warehouse import Warehouse
from tillscope.star import Star


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    s = star(spark, [{}, {"sale_id": 2, "ticket_id": "t2"}], [{}], first="1998-01-01", last="2025-12-31")
    warehouse = Warehouse(spark, "plan_shape", str(tmp_path_factory.mktemp("plans") / "db"))
    warehouse.write_star(s)
    return warehouse.star()


def summaries(s: Star):
    return {"regional_performance": r.m3(s), "inventory_alerts": r.m6(s), "daily_sales": summary.build_daily_summary(s)}


def test_no_plan_crosses_rows_or_leaves_the_jvm(stored):
    for name, plan in headline_queries(stored, summaries(stored)).items():
        text = physical(plan())
        for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEval", "BatchEvalPython",
                         "FlatMapGroupsInPandas", "MapInPandas"):
            assert unwanted not in text, (name, unwanted)


def test_dated_plans_read_only_the_years_they_need(stored):
    text = physical(sales.daily_sales_by_chain(stored, *r.YEAR))
    filters = text.split("PartitionFilters: [")[1].split("]")[0]
    assert "sale_year" in filters and "2000" in filters


def test_scans_read_only_the_columns_used(stored):
    text = physical(sales.daily_net_by_chain(stored, *r.YEAR))
    scan = next(part for part in text.split("FileScan parquet ")[1:] if "unit_price" in part).split("]")[0]
    folders = {"sale_year", "sale_month", "made_from", "written_as"}
    assert {c.split("[")[-1].split(".")[-1].split("#")[0] for c in scan.split(",")} - folders == {
        "store_id", "sale_date", "quantity", "unit_price", "discount_pct"
    }


def test_stores_and_days_are_broadcast_and_the_lines_are_not_shuffled_for_them(stored):
    text = physical(sales.daily_sales_by_chain(stored, *r.YEAR))
    assert text.count("BroadcastHashJoin") == 2
    assert "SortMergeJoin" not in text


def test_nothing_is_broadcast_above_the_threshold(spark, stored):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        text = physical(products.sales_by_channel(stored, date(2024, 1, 1), date(2024, 12, 31)))
        assert "BroadcastHashJoin" not in text and "SortMergeJoin" in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_top_n_is_cut_before_the_shuffle(stored):
    assert "WindowGroupLimit" in physical(products.top_products_by_region(stored, r.AS_OF))
    assert "TakeOrderedAndProject" in physical(products.top_products(stored, 2000, 4))


def test_large_rankings_do_not_window_a_whole_group(stored):
    text = physical(products.regional_ranking(stored, r.AS_OF))
    windows = [line for line in text.splitlines() if "row_number()" in line and "Window" in line]
    assert windows and all("_band" in line and "_tie_band" in line for line in windows)


def test_plans_carry_no_broadcast_hint(stored):
    assert "ResolvedHint" not in sales.daily_sales_by_chain(stored, *r.YEAR)._jdf.queryExecution().analyzed().toString()


def test_stock_alerts_read_fresh_snapshots_only(stored):
    text = physical(inventory.stock_alerts(stored, r.AS_OF, lookback_days=r.LONG, min_obs=2, fresh_days=365))
    assert any("snapshot_date" in line and ">=" in line for line in text.splitlines() if "PushedFilters" in line)


def test_tickets_are_cut_to_the_range_before_they_are_grouped(stored):
    text = physical(tickets.weekly_ticket_by_format(stored, *r.YEAR))
    assert "LeftSemi" in text


def test_rankings_scan_the_lines_once(stored):
    assert "sales" not in physical(products.regional_ranking(stored, r.AS_OF)).lower().replace("net_sales", "")
