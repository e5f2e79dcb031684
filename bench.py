"""Time the headline queries on a stored star.

Loads the test tables once into a warehouse (timed apart as ``load_sec``),
builds the summary tables (``build_sec``), then times every query to the end of
its full result. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks import registry as r  # noqa: E402
from tillscope import testbind  # noqa: E402
from tillscope.operators import quality  # noqa: E402
from tillscope.plans import advanced, inventory, kpi, metrics, products, sales, season, served, state, summary, tickets  # noqa: E402
from tillscope.sources.shared import fresh_folder  # noqa: E402
from tillscope.sources.warehouse import Warehouse  # noqa: E402
from tillscope.star import Star  # noqa: E402

DATA = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("tillscope-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df: DataFrame) -> None:
    """Compute every row and column without moving them to the driver."""
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    began = time.perf_counter()
    action()
    return time.perf_counter() - began


def headline_queries(star: Star, read: dict[str, DataFrame]) -> dict[str, Callable[[], DataFrame]]:
    """Plans by name; those named ``summary`` read the summary tables."""
    return {
        "q1_1": lambda: sales.daily_sales_by_chain(star, *r.YEAR),
        "q1_2": lambda: sales.weekly_sales_trend(star, r.AS_OF),
        "q1_3": lambda: sales.store_ranking(star, *r.QUARTER),
        "q2_1": lambda: products.top_products(star, 2000, 4),
        "q2_2": lambda: products.top_products_by_region(star, r.AS_OF),
        "q2_3": lambda: products.sales_by_channel(star, *r.YEAR),
        "q3_1": lambda: tickets.weekly_ticket_by_format(star, *r.YEAR),
        "q3_2": lambda: tickets.monthly_ticket_by_region(star, *r.YEAR),
        "q3_3": lambda: tickets.hourly_tickets(star, *r.NOVEMBER),
        "q4_1": lambda: inventory.stock_alerts(star, r.AS_OF, lookback_days=r.LONG, min_obs=2, fresh_days=365),
        "q4_2": lambda: inventory.inventory_turnover(star, *r.YEAR),
        "q4_3": lambda: inventory.stockout_frequency(star, *r.YEAR, min_snapshots=3),
        "q5_1": lambda: season.seasonality_index(star, 1998, 2000),
        "q5_2": lambda: season.holiday_impact(star, 1998, 2000),
        "kpi1": lambda: kpi.sales_vs_previous(star, r.AS_OF),
        "kpi2": lambda: kpi.top_bottom_stores(star, r.AS_OF, min_days=3),
        "kpi3": lambda: kpi.category_matrix(star, r.AS_OF),
        "kpi4": lambda: kpi.channel_performance(star, r.AS_OF),
        "kpi5": lambda: kpi.inventory_health(star, r.AS_OF, days=31),
        "a1": lambda: advanced.category_affinity(star, *r.QUARTER),
        "a2": lambda: advanced.weekly_trend(star, 1998, 2000, 2000),
        "a3": lambda: advanced.price_elasticity(star, *r.YEAR, min_stores=2),
        "a4": lambda: advanced.store_segments(star, *r.YEAR, min_days=15),
        "a5": lambda: advanced.store_cohort(star, *r.YEAR),
        "x3": lambda: metrics.margin(star, *r.YEAR),
        "dq": lambda: quality.check(star),
        "e1_daily_sales_quarter": lambda: sales.daily_sales_by_chain_quarter(star, *r.QUARTER),
        "e2a_regional_ranking_base": lambda: products.regional_ranking(star, r.AS_OF),
        "e2b_regional_ranking_summary": lambda: products.regional_ranking_fast(
            read["regional_performance"], r.AS_OF
        ),
        "e3a_inventory_alerts_base": lambda: inventory.inventory_alerts_full(
            star, r.AS_OF, lookback_days=r.LONG, min_days=2
        ),
        "e3b_critical_alerts_summary": lambda: inventory.critical_alerts(read["inventory_alerts"]),
        "r1_daily_kpis_summary": lambda: summary.daily_kpis(read["daily_sales"], r.AS_OF, "BUILDING"),
    }


def maintained_queries(store: summary.SummaryStore, star: Star) -> dict[str, Callable[[], DataFrame]]:
    """Plans over maintained state, and reads of the tables that are kept ready for the dashboard."""
    positions, costs = state.current_positions(store, star), state.current_costs(store, star)
    return {
        "e3a_inventory_alerts_positions": lambda: inventory.inventory_alerts_full(
            star, r.AS_OF, lookback_days=r.LONG, min_days=2, positions=positions
        ),
        "x3_intervals": lambda: metrics.margin(star, *r.YEAR, costs),
        "e2b_regional_ranking_served": lambda: served.regional_ranking(store),
        "e3b_critical_alerts_served": lambda: served.critical_alerts(store),
        "r1_daily_kpis_served": lambda: served.daily_kpis(store, r.AS_OF, "BUILDING"),
    }


def main() -> None:
    spark = session()
    warehouse = Warehouse(spark, "bench_retail", fresh_folder(spark))
    load = timed(lambda: warehouse.write_star(testbind.star(spark, DATA)))
    star = warehouse.star()
    store = summary.SummaryStore(spark, "bench_summary", fresh_folder(spark))
    build = {
        name: timed(lambda: summary.refresh(store, star, r.AS_OF, [name], r.TEST_SUMMARIES))
        for name in r.TEST_SUMMARIES
    }
    build["served"] = timed(lambda: served.refresh(store, r.AS_OF))
    build["positions"] = timed(lambda: state.refresh_positions(store, star))
    build["costs"] = timed(lambda: state.refresh_costs(store, star))
    queries = headline_queries(star, {name: store.read(name) for name in r.TEST_SUMMARIES}) | maintained_queries(store, star)
    chosen = sys.argv[1:]
    first, usual = {}, {}
    for name, plan in queries.items():
        if chosen and not any(name.startswith(c) for c in chosen):
            continue
        first[name] = round(timed(lambda: run(plan())), 4)
        usual[name] = round(statistics.median(timed(lambda: run(plan())) for _ in range(RUNS)), 4)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(usual.values()), 3),
                "unit": "sec",
                "queries": usual,
                "first_run": first,
                "load_sec": round(load, 2),
                "build_sec": {name: round(sec, 2) for name, sec in build.items()},
                "sf": DATA.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": int(CPUS),
            }
        )
    )


if __name__ == "__main__":
    main()
