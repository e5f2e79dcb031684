"""Tables that answer the dashboard's reads by a scan and a filter: ranks, urgent alerts and daily figures, kept ready.

They are made from the published summaries, at the end of a refresh. Ranks are stored as columns and rows in the order of
the read, so a reader neither aggregates nor sorts, and nothing is exchanged; rows come in stored order as far as files
are read in order, and their rank or priority is a column to sort a shown page by.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.functions.measures import ratio
from tillscope.functions.periods import days_before, month_start
from tillscope.operators.ranking import number_descending, rank_descending
from tillscope.plans.inventory import LOW_STOCK, OUT_OF_STOCK, PAIR
from tillscope.plans.summary import SummaryStore
from tillscope.sources.shared import scratch

RANKING, CATEGORY_RANKS, URGENT, DAILY = "served_ranking", "served_category_ranks", "served_urgent", "served_daily"
_RANKED = ["region", "product_id", "category", "brand", "product_name", "net_sales", "units", "stores"]


def refresh(store: SummaryStore, as_of: date, min_net: int = 1000) -> None:
    """Make all tables anew from ``regional_performance``, ``inventory_alerts`` and ``daily_sales``."""
    month = store.read("regional_performance").filter(F.col("month") == F.lit(month_start(as_of)))
    with scratch(store.spark):
        numbered = number_descending(
            month.filter(F.col("net_sales") > min_net), ["region"], "net_sales", "product_id", "region_rank"
        )
        store.publish(RANKING, _sorted(numbered.select(*_RANKED, "region_rank"), "region_rank", "region"), as_of)
        ranked = rank_descending(month, ["category", "region"], "net_sales", "category_rank")
        columns = ["category", "region", "product_id", "product_name", "brand", "units", "net_sales", "category_rank"]
        store.publish(CATEGORY_RANKS, _sorted(ranked.select(*columns), "category", "region", "category_rank"), as_of)
        urgent = store.read("inventory_alerts").filter(F.col("alert").isin(OUT_OF_STOCK, LOW_STOCK))
        store.publish(URGENT, _sorted(urgent, "priority", "category", "chain", *PAIR), as_of)
        per_day = (
            store.read("daily_sales")
            .groupBy("sale_date", "chain")
            .agg(F.sum("net_sales").cast("decimal(38,6)").alias("net_sales"), F.sum("tickets").alias("tickets"))
            .withColumn("net_per_ticket", ratio("net_sales", "tickets"))
        )
        store.publish(DAILY, _sorted(per_day, "sale_date", "chain"), as_of)
    store.vacuum()


def _sorted(rows: DataFrame, *columns: str) -> DataFrame:
    """Rows in files that follow each other in the order of the columns."""
    return rows.repartitionByRange(*columns).sortWithinPartitions(*columns)


def regional_ranking(store: SummaryStore, n: int = 10) -> DataFrame:
    """The first ``n`` products of every region in the month of the refresh."""
    return store.read(RANKING).filter(F.col("region_rank") <= n)


def top_in_category_region(store: SummaryStore, category: str, region: str, n: int = 5) -> DataFrame:
    """Products up to rank ``n`` of a category in a region in the month of the refresh; ties at the end all stay."""
    chosen = (F.col("category") == category) & (F.col("region") == region) & (F.col("category_rank") <= n)
    return store.read(CATEGORY_RANKS).filter(chosen).select("product_id", "product_name", "brand", "units", "net_sales")


def critical_alerts(store: SummaryStore) -> DataFrame:
    """Stockouts and low stock."""
    return store.read(URGENT)


def daily_kpis(store: SummaryStore, as_of: date, chain: str, days: int = 7) -> DataFrame:
    """Daily net sales, tickets and net per ticket of a chain."""
    return store.read(DAILY).filter((F.col("sale_date") >= F.lit(days_before(as_of, days))) & (F.col("chain") == chain))
