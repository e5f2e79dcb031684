"""Executive dashboard figures."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillscope.functions.measures import NET_X100, change_pct, money, net_sales, ratio, real, share_pct, with_net
from tillscope.functions.periods import days_before, snapshots_between, sold_between
from tillscope.operators.joins import with_product
from tillscope.plans.sales import store_daily_average
from tillscope.star import Star

# Row labels of the dashboard.
KPI_NET_SALES = "Ventas Netas"
KPI_TICKETS = "Transacciones"
KPI_AVG_LINE = "Ticket Promedio"
TOP_STORES = "TOP_5"
BOTTOM_STORES = "BOTTOM_5"


def sales_vs_previous(star: Star, as_of: date, days: int = 30) -> DataFrame:
    """Net sales, tickets and mean line of two periods, and their change.

    Both periods include their end days, so they share the day ``as_of -
    days``. One scan fills both: a ticket is reduced to one row with its
    figures for either period.
    """
    middle = days_before(as_of, days)
    lines = with_net(sold_between(star.sales, days_before(as_of, 2 * days), as_of))
    now, before = F.col("sale_date") >= F.lit(middle), F.col("sale_date") <= F.lit(middle)

    def line_figures(period: Column, prefix: str) -> list[Column]:
        net = F.when(period, F.col(NET_X100))
        return [
            F.sum(net).alias(f"{prefix}_net"),
            F.count(net).alias(f"{prefix}_valued"),
            F.count_if(period).alias(f"{prefix}_lines"),
        ]

    per_ticket = lines.groupBy("ticket_id").agg(*line_figures(now, "now"), *line_figures(before, "before"))

    def totals(prefix: str) -> list[Column]:
        is_ticket = F.col("ticket_id").isNotNull() & (F.col(f"{prefix}_lines") > 0)
        net = money(F.sum(f"{prefix}_net"))
        return [
            real(net).alias(f"{prefix}_sales"),
            real(F.count_if(is_ticket)).alias(f"{prefix}_tickets"),
            ratio(net, F.sum(f"{prefix}_valued")).alias(f"{prefix}_line"),
        ]

    both = per_ticket.agg(*totals("now"), *totals("before"))
    rows = F.array(
        *[
            F.struct(
                F.lit(label).alias("kpi"),
                F.col(f"now_{figure}").alias("current_value"),
                F.col(f"before_{figure}").alias("previous_value"),
                change_pct(f"now_{figure}", f"before_{figure}").alias("change_pct"),
            )
            for label, figure in ((KPI_NET_SALES, "sales"), (KPI_TICKETS, "tickets"), (KPI_AVG_LINE, "line"))
        ]
    )
    return both.select(F.inline(rows))


def top_bottom_stores(star: Star, as_of: date, days: int = 30, n: int = 5, min_days: int = 20) -> DataFrame:
    """Best and worst stores by sale per active day; a store may be in both."""
    stores = store_daily_average(star, days_before(as_of, days), as_of).filter(F.col("active_days") >= min_days)

    def cut(label: str, order: Column) -> DataFrame:
        return stores.orderBy(order, "store_id").limit(n).select(
            F.lit(label).alias("group"), "chain", "store_id", "store_name", "format", "region",
            "net_sales", "avg_daily_sale",
        )

    best = cut(TOP_STORES, F.desc_nulls_first("avg_daily_sale"))
    worst = cut(BOTTOM_STORES, F.asc_nulls_last("avg_daily_sale"))
    return best.unionByName(worst).orderBy(F.desc("group"), F.desc_nulls_first("avg_daily_sale"))


def _share_of_total(amount: str) -> Column:
    """Part of the column's total in percent; runs on rows already aggregated."""
    return ratio(amount, F.sum(amount).over(Window.partitionBy())) * 100.0


def category_matrix(star: Star, as_of: date, days: int = 90) -> DataFrame:
    """Active products, units, net sales and share per category."""
    per_product = (
        with_net(sold_between(star.sales, days_before(as_of, days), as_of))
        .groupBy("product_id")
        .agg(
            F.sum("quantity").alias("quantity"),
            F.sum(NET_X100).alias(NET_X100),
            F.sum("unit_price").alias("price_sum"),
            F.count("unit_price").alias("prices"),
        )
    )
    return (
        with_product(per_product, star.products, "category")
        .groupBy("category")
        .agg(
            F.count("*").alias("active_products"),
            F.sum("quantity").alias("units"),
            net_sales().alias("net_sales"),
            ratio(F.sum("price_sum"), F.sum("prices")).alias("avg_price"),
        )
        .withColumn("sales_share_pct", _share_of_total("net_sales"))
        .orderBy(F.desc_nulls_first("net_sales"))
    )


def channel_performance(star: Star, as_of: date, days: int = 30) -> DataFrame:
    """Tickets, units, net sales and share per channel."""
    return (
        with_net(sold_between(star.sales, days_before(as_of, days), as_of))
        .filter(F.col("ticket_id").isNotNull())
        .groupBy("channel")
        .agg(
            F.count_distinct("ticket_id").alias("tickets"),
            F.sum("quantity").alias("units"),
            net_sales().alias("net_sales"),
            ratio(net_sales(), F.count(NET_X100)).alias("avg_line_value"),
        )
        .withColumn("share_pct", _share_of_total("net_sales"))
        .orderBy(F.desc_nulls_first("net_sales"))
    )


def inventory_health(star: Star, as_of: date, days: int = 7, low: int = 10) -> DataFrame:
    """Stockout and low-stock rates and mean stock value per category."""
    value = F.col("final_stock") * F.col("unit_cost")
    per_product = (
        snapshots_between(star.inventory, days_before(as_of, days))
        .groupBy("product_id")
        .agg(
            F.count("*").alias("positions"),
            F.count_if(F.col("final_stock") == 0).alias("stockouts"),
            F.count_if(F.col("final_stock") < low).alias("low_stock"),
            F.sum(value).alias("value"),
            F.count(value).alias("valued"),
        )
    )
    return (
        with_product(per_product, star.products, "category")
        .groupBy("category")
        .agg(
            *[F.sum(c).alias(c) for c in ("positions", "stockouts", "low_stock")],
            ratio(F.sum("value"), F.sum("valued")).alias("avg_stock_value"),
        )
        .withColumn("stockout_rate_pct", share_pct("stockouts", "positions"))
        .withColumn("low_stock_rate_pct", share_pct("low_stock", "positions"))
        .orderBy(F.desc("stockout_rate_pct"))
    )
