"""Metrics that the data model documents beyond its reports."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillscope.functions.measures import NET_X100, gross_value, money, net_sales, ratio, with_net
from tillscope.functions.periods import snapshots_between, sold_between
from tillscope.operators.joins import with_product, with_store
from tillscope.plans.inventory import PAIR
from tillscope.plans.kpi import inventory_health
from tillscope.plans.sales import store_daily_average
from tillscope.star import Star


def store_vs_chain(star: Star, start: date, end: date) -> DataFrame:
    """Each store's net sales against the mean of its chain."""
    chain = Window.partitionBy("chain")
    stores = store_daily_average(star, start, end).withColumn(
        "chain_mean", ratio(F.sum("net_sales").over(chain), F.count("net_sales").over(chain))
    )
    net, mean = F.col("net_sales").cast("double"), F.col("chain_mean")
    position = F.when(net > mean, "above").when(net < mean, "below").otherwise("equal")
    return stores.select(
        "chain", "store_id", "store_name", "net_sales", "chain_mean", position.alias("position")
    ).orderBy("chain", F.desc_nulls_first("net_sales"))


def _sold_by_day(star: Star, start: date, end: date) -> DataFrame:
    """One row per product, store and day."""
    return (
        with_net(sold_between(star.sales, start, end))
        .groupBy(*PAIR, F.col("sale_date").alias("day"))
        .agg(F.sum("quantity").alias("quantity"), F.sum(NET_X100).alias(NET_X100))
    )


def with_cost_as_of(star: Star, start: date, end: date) -> DataFrame:
    """Daily sales per pair with the unit cost of its last snapshot so far.

    Sales are reduced to one row per product, store and day before the as-of
    step, and the snapshots before the range to the newest per pair, so a pair's
    series holds at most two rows per day of the range. The series is the union
    of sale days and snapshots; a snapshot of the sale's own day counts.
    """
    costed = star.inventory.filter(F.col("unit_cost").isNotNull())
    inside = (
        snapshots_between(costed, start, end)
        .groupBy(*PAIR, F.col("snapshot_date").alias("day"))
        .agg(F.max("unit_cost").alias("unit_cost"))
    )
    newest = F.max(F.struct("snapshot_date", "unit_cost"))
    before = (
        snapshots_between(costed, None, start - timedelta(days=1))
        .groupBy(*PAIR)
        .agg(newest["snapshot_date"].alias("day"), newest["unit_cost"].alias("unit_cost"))
    )
    costs = inside.unionByName(before).withColumn("is_sale", F.lit(0))
    series = Window.partitionBy(*PAIR).orderBy("day", "is_sale")
    return (
        _sold_by_day(star, start, end)
        .withColumn("is_sale", F.lit(1))
        .unionByName(costs, allowMissingColumns=True)
        .withColumn("unit_cost", F.last("unit_cost", ignorenulls=True).over(series))
        .filter("is_sale = 1")
        .drop("is_sale")
    )


def with_cost_of_interval(star: Star, start: date, end: date, costs: DataFrame) -> DataFrame:
    """Daily sales per pair with the unit cost of the interval (``plans/state``) that holds the day.

    Only the intervals of the range's years are read. At most one holds a day,
    so the join adds no rows; a pair has few in a year.
    """
    sold = _sold_by_day(star, start, end).withColumn("cost_year", F.year("day"))
    valid = costs.filter(F.col("cost_year").between(start.year, end.year))
    held = [sold[c] == valid[c] for c in (*PAIR, "cost_year")]
    inside = sold["day"].between(valid["valid_from"], valid["valid_to"])
    joined = sold.join(valid, [*held, inside], "left")
    return joined.select(*[sold[c] for c in (*PAIR, "day", "quantity", NET_X100)], valid["unit_cost"])


def margin(star: Star, start: date, end: date, costs: DataFrame | None = None) -> DataFrame:
    """Net sales, cost and margin per category and month.

    Margin covers the sales whose cost is known; ``uncosted_units`` tells how
    many units it leaves out. With maintained cost intervals (``plans/state``)
    no snapshot is read.
    """
    cost = F.col("quantity") * F.col("unit_cost")
    known = F.col("unit_cost").isNotNull()
    per_product = (
        (with_cost_as_of(star, start, end) if costs is None else with_cost_of_interval(star, start, end, costs))
        .withColumn("month", F.trunc("day", "MM"))
        .groupBy("product_id", "month")
        .agg(
            F.sum("quantity").alias("units"),
            F.coalesce(F.sum(F.when(~known, F.col("quantity"))), F.lit(0)).alias("uncosted_units"),
            F.sum(NET_X100).alias(NET_X100),
            F.sum(F.when(known, F.col(NET_X100))).alias("costed_net_x100"),
            F.sum(cost).alias("cost"),
        )
    )
    costed = money(F.sum("costed_net_x100"))
    return (
        with_product(per_product, star.products, "category")
        .groupBy("category", "month")
        .agg(
            F.sum("units").alias("units"),
            F.sum("uncosted_units").alias("uncosted_units"),
            net_sales().alias("net_sales"),
            F.sum("cost").alias("cost"),
            (costed - F.sum("cost")).cast("decimal(38,6)").alias("margin"),
        )
        .withColumn("margin_per_cost", ratio("margin", "cost"))
        .orderBy("category", "month")
    )


def gross_sales(star: Star, start: date, end: date) -> DataFrame:
    """Gross, net and discount value per chain."""
    lines = with_net(sold_between(star.sales, start, end)).withColumn("gross", gross_value())
    return (
        with_store(lines, star.stores, "chain")
        .groupBy("chain")
        .agg(F.sum("gross").cast("decimal(38,6)").alias("gross_sales"), net_sales().alias("net_sales"))
        .withColumn("discount_value", (F.col("gross_sales") - F.col("net_sales")).cast("decimal(38,6)"))
        .orderBy("chain")
    )


def low_stock_share(star: Star, as_of: date, days: int = 7, low: int = 10) -> DataFrame:
    """Share of positions below ``low`` units per category."""
    return inventory_health(star, as_of, days, low).select("category", "positions", "low_stock", "low_stock_rate_pct")
