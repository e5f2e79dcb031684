"""Stock levels, alerts, turnover and stockouts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillscope.functions.measures import ratio, real, share_pct
from tillscope.functions.periods import calendar_days, days_before, snapshots_between, sold_between
from tillscope.operators.joins import with_product, with_store
from tillscope.star import Star

# Alert labels of the data model.
OUT_OF_STOCK = "SIN_STOCK"
LOW_STOCK = "STOCK_BAJO"
OVERSTOCK = "SOBRESTOCK"
NORMAL = "NORMAL"

PAIR = ["product_id", "store_id"]


def latest_stock(inventory: DataFrame) -> DataFrame:
    """Newest snapshot per product and store.

    ``max_by`` over fixed-width columns keeps this one hash aggregate with a
    partial step per task: no self-join and no window over a pair's history.
    """
    return inventory.groupBy(*PAIR).agg(
        F.max("snapshot_date").alias("snapshot_date"),
        F.max_by("final_stock", "snapshot_date").alias("final_stock"),
        F.max_by("unit_cost", "snapshot_date").alias("unit_cost"),
    )


def stock_label(days_of_supply: Column, low: int, high: int) -> Column:
    """Alert label; a NULL ratio is normal unless the stock is zero."""
    return (
        F.when(F.col("final_stock") == 0, OUT_OF_STOCK)
        .when(days_of_supply < low, LOW_STOCK)
        .when(days_of_supply > high, OVERSTOCK)
        .otherwise(NORMAL)
    )


def label_priority(label: Column, levels: int = 4) -> Column:
    """Sort position of a label; with three levels overstock counts as the rest."""
    third = F.when(label == OVERSTOCK, 3).otherwise(4) if levels == 4 else F.lit(3)
    return F.when(label == OUT_OF_STOCK, 1).when(label == LOW_STOCK, 2).otherwise(third)


def mean_quantity() -> Column:
    """Mean quantity per sale line."""
    return ratio(F.sum("quantity"), F.count("quantity"))


def stock_alerts(
    star: Star,
    as_of: date,
    lookback_days: int = 30,
    min_obs: int = 5,
    fresh_days: int = 7,
    low: int = 7,
    high: int = 60,
) -> DataFrame:
    """Latest stock with days of supply, for pairs with a fresh snapshot.

    Mean sales need ``min_obs`` lines in the look-back; without them the days
    of supply are unknown and the label is normal.
    """
    recent = (
        sold_between(star.sales, days_before(as_of, lookback_days))
        .groupBy(*PAIR)
        .agg(mean_quantity().alias("avg_daily_sales"), F.count("*").alias("observations"))
        .filter(F.col("observations") >= min_obs)
        .drop("observations")
    )
    # The newest snapshot of a pair is fresh if any is, so older ones are not read.
    fresh = snapshots_between(star.inventory, days_before(as_of, fresh_days))
    current = latest_stock(fresh)
    supply = ratio("final_stock", "avg_daily_sales")
    rows = current.join(recent, PAIR, "left").withColumns(
        {
            "days_of_supply": F.when(F.col("avg_daily_sales") > 0, supply),
            "alert": stock_label(supply, low, high),
        }
    )
    rows = with_store(rows, star.stores, "chain", "store_name")
    rows = with_product(rows, star.products, "category", "brand", "product_name")
    return rows.select(
        *PAIR, "category", "brand", "product_name", "chain", "store_name",
        F.col("final_stock").alias("current_stock"), "avg_daily_sales", "days_of_supply", "snapshot_date", "alert",
    ).orderBy(label_priority(F.col("alert")), "category", "chain", *PAIR)


def inventory_turnover(star: Star, start: date, end: date) -> DataFrame:
    """Turnover and days of inventory by category and store format.

    A snapshot meets every sale line of its product, store and day. Lines are
    reduced to a count and a quantity per key first, and only lines of
    snapshot days take part in the shuffle.
    """
    snapshots = snapshots_between(star.inventory, start, end).select(
        *PAIR, F.col("snapshot_date").alias("sale_date"), "final_stock", "unit_cost"
    )
    snapshot_days = (
        calendar_days(star.calendar, start, end)
        .select("sale_date")
        .join(snapshots.select("sale_date").distinct(), "sale_date", "left_semi")
    )
    sold = (
        sold_between(star.sales, start, end)
        .join(snapshot_days, "sale_date", "left_semi")
        .groupBy(*PAIR, "sale_date")
        .agg(F.count("*").alias("lines"), F.sum("quantity").alias("quantity"))
    )
    value = F.col("final_stock") * F.col("unit_cost")
    per_product = (
        with_store(snapshots.join(sold, [*PAIR, "sale_date"]), star.stores, "format")
        .groupBy("product_id", "format")
        .agg(
            F.sum(value * F.col("lines")).alias("weighted_value"),
            F.sum(F.when(value.isNotNull(), F.col("lines"))).alias("lines"),
            F.sum(F.col("quantity") * F.col("unit_cost")).alias("cost"),
        )
    )
    average, cost = F.col("avg_inventory"), F.col("cost_of_sales")
    return (
        with_product(per_product, star.products, "category")
        .groupBy("category", "format")
        .agg(
            ratio(F.sum("weighted_value"), F.sum("lines")).alias("avg_inventory"),
            real(F.sum("cost")).alias("cost_of_sales"),
        )
        .withColumn("turnover", F.when(average > 0, cost / average).otherwise(0.0))
        .withColumn("days_of_inventory", F.when(cost > 0, average / cost * 365).otherwise(0.0))
        .orderBy(F.desc_nulls_first("turnover"))
    )


def stockout_frequency(
    star: Star, start: date, end: date, low: int = 5, min_snapshots: int = 10
) -> DataFrame:
    """Stockout and low-stock rates by category, brand, region and format."""
    keys = ["category", "brand", "region", "format"]
    per_product = (
        with_store(snapshots_between(star.inventory, start, end), star.stores, "region", "format")
        .groupBy("product_id", "region", "format")
        .agg(
            F.count("*").alias("snapshots"),
            F.count_if(F.col("final_stock") == 0).alias("stockouts"),
            F.count_if(F.col("final_stock") < low).alias("low_stock"),
        )
    )
    return (
        with_product(per_product, star.products, "category", "brand")
        .groupBy(*keys)
        .agg(*[F.sum(c).alias(c) for c in ("snapshots", "stockouts", "low_stock")])
        .filter(F.col("snapshots") >= min_snapshots)
        .withColumn("stockout_rate_pct", share_pct("stockouts", "snapshots"))
        .withColumn("low_stock_rate_pct", share_pct("low_stock", "snapshots"))
        .orderBy(F.desc("stockout_rate_pct"), "category", "brand")
    )


def inventory_alerts_full(
    star: Star,
    as_of: date,
    lookback_days: int = 30,
    min_days: int = 5,
    low: int = 7,
    high: int = 60,
    positions: DataFrame | None = None,
) -> DataFrame:
    """Alerts for the latest snapshot of every pair, however old.

    Without recent sales the label compares the stock itself, while the days
    of supply stay unknown. With maintained ``positions`` (``plans/state``) no
    snapshot is read.
    """
    recent = (
        recent_sales(star, as_of, lookback_days, min_days).select(*PAIR, "avg_daily_sales")
    )
    latest = latest_stock(star.inventory) if positions is None else positions
    rows = with_supply(latest.join(recent, PAIR, "left"), low, high)
    rows = with_store(rows, star.stores, "chain", "store_name", "region")
    rows = with_product(rows, star.products, "category", "brand", "product_name")
    return rows.select(
        *PAIR, "category", "brand", "product_name", "chain", "store_name", "region",
        "final_stock", "avg_daily_sales", "days_of_supply", "alert", "snapshot_date",
    ).orderBy(label_priority(F.col("alert"), levels=3), "category", "chain", *PAIR)


def recent_sales(star: Star, as_of: date, lookback_days: int = 30, min_days: int = 3) -> DataFrame:
    """Mean line quantity, sales days, total and last date per pair."""
    per_day = (
        sold_between(star.sales, days_before(as_of, lookback_days))
        .groupBy(*PAIR, "sale_date")
        .agg(F.sum("quantity").alias("quantity"), F.count("quantity").alias("lines"))
    )
    return (
        per_day.groupBy(*PAIR)
        .agg(
            ratio(F.sum("quantity"), F.sum("lines")).alias("avg_daily_sales"),
            F.count("sale_date").alias("sales_days"),
            F.sum("quantity").alias("total_quantity"),
            F.max("sale_date").alias("last_sale_date"),
        )
        .filter(F.col("sales_days") >= min_days)
    )


def with_supply(rows: DataFrame, low: int, high: int) -> DataFrame:
    """Days of supply and label where a missing mean counts as one unit a day."""
    mean = F.col("avg_daily_sales")
    supply_or_stock = ratio(F.col("final_stock"), F.coalesce(mean, F.lit(1.0)))
    return rows.withColumns(
        {
            "days_of_supply": F.when(mean > 0, ratio("final_stock", mean)),
            "alert": stock_label(supply_or_stock, low, high),
            "avg_daily_sales": F.coalesce(mean, F.lit(0.0)),
        }
    )


def critical_alerts(alerts: DataFrame) -> DataFrame:
    """Stockouts and low stock from the alert summary, most urgent first."""
    return alerts.filter(F.col("alert").isin(OUT_OF_STOCK, LOW_STOCK)).orderBy("priority", "category", "chain", *PAIR)


def alerts_for_chain(alerts: DataFrame, chain: str) -> DataFrame:
    """Stockouts and low stock of one chain from the alert summary."""
    return alerts.filter((F.col("chain") == chain) & F.col("alert").isin(OUT_OF_STOCK, LOW_STOCK)).select(
        "product_id", "store_id", "store_name", "product_name", "final_stock", "alert"
    )
