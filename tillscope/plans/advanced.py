"""Basket affinity, trends, elasticity, segments and cohorts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillscope.functions.measures import NET_X100, change_pct, money, net_sales, ratio, share_pct, with_net
from tillscope.functions.periods import calendar_days, sold_between, year_span
from tillscope.operators.joins import with_day, with_product, with_product_of_lines, with_store
from tillscope.star import Star


def category_affinity(
    star: Star, start: date, end: date, min_pairs: int = 100, n: int = 20
) -> DataFrame:
    """Category pairs bought together.

    An occurrence is a pair of product names of two categories in a ticket;
    its value is the sum of both. Instead of building those pairs, a ticket is
    reduced to one entry per category: names n, those with a value m, and
    value v. The ticket adds na*nb occurrences; ma*mb of them have a value, in
    all va*mb + vb*ma. So only category pairs are formed, and they are summed
    in the same task. Products without a category take no part.
    """
    lines = with_net(sold_between(star.sales, start, end)).filter(F.col("ticket_id").isNotNull())
    bought = lines.groupBy("ticket_id", "product_id").agg(F.sum(NET_X100).cast("decimal(38,4)").alias("value"))
    baskets = (
        with_product_of_lines(bought, star.products, "category", "product_name", counted=lines)
        .filter(F.col("category").isNotNull())
        .groupBy("ticket_id", "category", "product_name")
        .agg(F.sum("value").cast("decimal(38,4)").alias("value"))
        .groupBy("ticket_id", "category")
        .agg(
            F.count("*").alias("names"),
            F.count("value").alias("valued"),
            F.coalesce(F.sum("value"), F.lit(0)).cast("decimal(38,4)").alias("value"),
        )
        .groupBy("ticket_id")
        .agg(F.sort_array(F.collect_list(F.struct("category", "names", "valued", "value"))).alias("entries"))
        .filter(F.size("entries") > 1)
    )
    pairs = (
        baskets.select("entries", F.posexplode("entries").alias("place", "a"))
        .select("a", F.explode(F.slice("entries", F.col("place") + 2, F.size("entries"))).alias("b"))
        .select(
            F.col("a.category").alias("category_a"),
            F.col("b.category").alias("category_b"),
            (F.col("a.names") * F.col("b.names")).alias("pairs"),
            (F.col("a.valued") * F.col("b.valued")).alias("valued"),
            (
                F.col("a.value") * F.col("b.valued").cast("decimal(10,0)")
                + F.col("b.value") * F.col("a.valued").cast("decimal(10,0)")
            ).alias("value"),
        )
    )
    strongest = (
        pairs.groupBy("category_a", "category_b")
        .agg(F.sum("pairs").alias("co_occurrences"), F.sum("valued").alias("valued"), F.sum("value").alias("value"))
        .filter(F.col("co_occurrences") >= min_pairs)
        .withColumn("avg_joint_value", ratio(money(F.col("value")), "valued"))
        .orderBy(F.desc("co_occurrences"), "category_a", "category_b")
        .limit(n)
    )
    return (
        strongest.withColumn("affinity_rank", F.rank().over(Window.orderBy(F.desc("co_occurrences"))))
        .select("category_a", "category_b", "co_occurrences", "avg_joint_value", "affinity_rank")
        .orderBy(F.desc("co_occurrences"), "category_a", "category_b")
    )


def weekly_trend(star: Star, year_from: int, year_to: int, show_year: int) -> DataFrame:
    """Weekly net sales by category and region with growth and moving mean.

    Growth compares with the row before and the row 52 rows before; gaps in a
    series shift them. The windows see all years, the result one.
    """
    start, end = year_span(year_from, year_to)
    days = calendar_days(star.calendar, start, end).filter(F.col("year").between(year_from, year_to))
    lines = with_day(with_net(sold_between(star.sales, start, end)), days, "year", "iso_week")
    per_product = (
        with_store(lines, star.stores, "region")
        .groupBy("product_id", "year", "iso_week", "region")
        .agg(F.sum(NET_X100).alias(NET_X100))
    )
    weekly = (
        with_product(per_product, star.products, "category")
        .groupBy("category", "region", "year", "iso_week")
        .agg(net_sales().alias("net_sales"))
    )
    series = Window.partitionBy("category", "region").orderBy("year", "iso_week")
    last_12 = series.rowsBetween(-11, 0)
    return (
        weekly.withColumn("_week_before", F.lag("net_sales", 1).over(series))
        .withColumn("_year_before", F.lag("net_sales", 52).over(series))
        .withColumn(
            "moving_avg_12", ratio(F.sum("net_sales").over(last_12), F.count("net_sales").over(last_12))
        )
        .filter(F.col("year") == show_year)
        .withColumn("week_growth_pct", change_pct("net_sales", "_week_before"))
        .withColumn("year_growth_pct", change_pct("net_sales", "_year_before"))
        .drop("_week_before", "_year_before")
        .orderBy("category", "region", F.desc("iso_week"))
    )


def price_elasticity(
    star: Star, start: date, end: date, min_stores: int = 5, min_step: float = 0.5
) -> DataFrame:
    """Volume change over price change against a product's previous month.

    Months count only if enough stores sold the product. The previous month is
    looked up per product id, so products of one name do not mix.
    """
    monthly = (
        sold_between(star.sales, start, end)
        .withColumn("month", F.trunc("sale_date", "MM"))
        .groupBy("product_id", "month")
        .agg(
            ratio(F.sum("unit_price"), F.count("unit_price")).alias("avg_price"),
            F.sum("quantity").alias("volume"),
            F.count_distinct("store_id").alias("stores"),
        )
        .filter(F.col("stores") >= min_stores)
    )
    series = Window.partitionBy("product_id").orderBy("month")
    price, volume = F.col("avg_price"), F.col("volume").cast("double")
    price_before = F.col("_price_before")
    volume_before = F.col("_volume_before").cast("double")
    elasticity = F.try_divide(
        F.try_divide(volume - volume_before, volume_before), F.try_divide(price - price_before, price_before)
    )
    stepped = (
        monthly.withColumn("_price_before", F.lag("avg_price").over(series))
        .withColumn("_volume_before", F.lag("volume").over(series))
        .filter(price_before.isNotNull() & (F.abs(price - price_before) > min_step))
        .withColumn("elasticity", F.round(elasticity, 2))
    )
    return (
        with_product(stepped, star.products, "category", "brand", "product_name")
        .select("product_id", "category", "brand", "product_name", "month", "avg_price", "volume", "elasticity")
        .orderBy("category", "brand", F.desc("month"))
    )


def store_metrics(star: Star, start: date, end: date, min_days: int = 300) -> DataFrame:
    """Yearly figures per store active on at least ``min_days`` days."""
    per_store = (
        with_net(sold_between(star.sales, start, end))
        .filter(F.col("ticket_id").isNotNull())
        .groupBy("store_id")
        .agg(
            net_sales().alias("net_sales"),
            F.count_distinct("sale_date").alias("active_days"),
            F.count_distinct("ticket_id").alias("tickets"),
            ratio(net_sales(), F.count(NET_X100)).alias("avg_line_value"),
            F.count_distinct("product_id").alias("variety"),
        )
        .filter(F.col("active_days") >= min_days)
    )
    return with_store(per_store, star.stores, "chain", "format", "region", "floor_area_m2").withColumn(
        "net_per_m2", ratio("net_sales", "floor_area_m2")
    )


def store_segments(star: Star, start: date, end: date, min_days: int = 300) -> DataFrame:
    """Stores grouped by quartiles of sales, mean line and productivity.

    The quartile windows run over one row per store, a set no larger than the
    store dimension. Groups are formed by the quartiles, so a label may fill
    several rows.
    """

    def quartile(column: str):
        return F.ntile(4).over(Window.orderBy(F.asc_nulls_last(column), "store_id"))

    ranked = store_metrics(star, start, end, min_days).select(
        "chain", "format", "region", "net_sales", "avg_line_value", "net_per_m2",
        quartile("net_sales").alias("q_sales"),
        quartile("avg_line_value").alias("q_line"),
        quartile("net_per_m2").alias("q_area"),
    )
    sales, line, area = F.col("q_sales"), F.col("q_line"), F.col("q_area")
    # Segment labels of the data model.
    segment = (
        F.when((sales == 4) & (line == 4), "PREMIUM")
        .when((sales == 4) & (area == 4), "HIGH_PERFORMANCE")
        .when(sales >= 3, "STRONG")
        .when(sales == 2, "AVERAGE")
        .otherwise("UNDERPERFORMING")
    )
    # Ratios of one store are doubles; their sum is taken in a fixed order.
    def ordered_mean(column: str):
        return ratio(
            F.aggregate(F.sort_array(F.collect_list(column)), F.lit(0.0), lambda total, x: total + x),
            F.count(column),
        )

    return (
        ranked.groupBy("chain", "format", "region", "q_sales", "q_line", "q_area")
        .agg(
            F.count("*").alias("stores"),
            ratio(F.sum("net_sales"), F.count("net_sales")).alias("avg_sales"),
            ordered_mean("avg_line_value").alias("avg_line_value"),
            ordered_mean("net_per_m2").alias("avg_net_per_m2"),
        )
        .withColumn("segment", segment)
        .select("chain", "format", "region", "stores", "avg_sales", "avg_line_value", "avg_net_per_m2", "segment")
        .orderBy(F.desc_nulls_first("avg_sales"))
    )


def store_cohort(star: Star, start: date, end: date) -> DataFrame:
    """Active stores per chain and month, and retention against the month before."""
    per_store = (
        with_net(sold_between(star.sales, start, end))
        .filter(F.col("ticket_id").isNotNull())
        .withColumn("month", F.trunc("sale_date", "MM"))
        .groupBy("store_id", "month")
        .agg(net_sales().alias("net_sales"), F.count_distinct("ticket_id").alias("tickets"))
    )
    monthly = (
        with_store(per_store, star.stores, "chain")
        .groupBy("chain", "month")
        .agg(
            F.count("*").alias("active_stores"),
            ratio(F.sum("net_sales"), F.count("net_sales")).alias("avg_sales_per_store"),
            F.sum("tickets").alias("tickets"),
        )
    )
    series = Window.partitionBy("chain").orderBy("month")
    return (
        monthly.withColumn("stores_month_before", F.lag("active_stores", 1).over(series))
        .withColumn("retention_pct", share_pct("active_stores", "stores_month_before"))
        .orderBy("chain", "month")
    )
