"""Product rankings and channel mix.

Sale lines are aggregated by product before the catalogue is joined, so a
catalogue of any size meets already reduced rows.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.functions.measures import NET_X100, net_sales, ratio, with_net
from tillscope.functions.periods import calendar_days, month_start, quarter_span, sold_between
from tillscope.operators.joins import with_day, with_product, with_store
from tillscope.operators.ranking import number_descending, top_per_group
from tillscope.star import Star


def top_products(star: Star, year: int, quarter: int, n: int = 20) -> DataFrame:
    """Best products of a calendar quarter by net sales."""
    start, end = quarter_span(year, quarter)
    quarter_days = calendar_days(star.calendar, start, end).filter(
        (F.col("year") == year) & (F.col("quarter") == quarter)
    )
    per_product = (
        with_day(with_net(sold_between(star.sales, start, end)), quarter_days)
        .groupBy("product_id")
        .agg(
            F.sum("quantity").alias("units"),
            net_sales().alias("net_sales"),
            ratio(F.sum("unit_price"), F.count("unit_price")).alias("avg_price"),
            F.count_distinct("store_id").alias("stores"),
            F.count_distinct("sale_date").alias("sale_days"),
        )
    )
    return (
        with_product(per_product, star.products, "category", "brand", "product_name")
        .select(
            "product_id", "category", "brand", "product_name",
            "units", "net_sales", "avg_price", "stores", "sale_days",
        )
        .orderBy(F.desc_nulls_first("net_sales"), "product_id")
        .limit(n)
    )


def top_products_by_region(star: Star, as_of: date, n: int = 10) -> DataFrame:
    """Best product names per region since the start of the month of ``as_of``."""
    lines = with_net(sold_between(star.sales, month_start(as_of)))
    per_product = (
        with_store(lines, star.stores, "region")
        .groupBy("region", "product_id")
        .agg(F.sum(NET_X100).alias(NET_X100), F.sum("quantity").alias("quantity"))
    )
    per_name = (
        with_product(per_product, star.products, "category", "product_name")
        .groupBy("region", "category", "product_name")
        .agg(net_sales().alias("net_sales"), F.sum("quantity").alias("units"))
    )
    order = [F.desc_nulls_first("net_sales"), F.asc("category"), F.asc("product_name")]
    return top_per_group(per_name, ["region"], order, n, "region_rank").orderBy("region", "region_rank")


def sales_by_channel(star: Star, start: date, end: date) -> DataFrame:
    """Products, units and net sales per category, subcategory and channel."""
    per_product = (
        with_net(sold_between(star.sales, start, end))
        .groupBy("product_id", "channel")
        .agg(
            F.sum("quantity").alias("quantity"),
            F.sum(NET_X100).alias(NET_X100),
            F.count(NET_X100).alias("lines"),
        )
    )
    return (
        with_product(per_product, star.products, "category", "subcategory")
        .groupBy("category", "subcategory", "channel")
        .agg(
            F.count("*").alias("products_sold"),
            F.sum("quantity").alias("units"),
            net_sales().alias("net_sales"),
            ratio(net_sales(), F.sum("lines")).alias("avg_line_value"),
        )
        .orderBy("category", F.desc_nulls_first("net_sales"))
    )


def regional_ranking(star: Star, as_of: date, min_net: int = 1000) -> DataFrame:
    """Every product above ``min_net`` since month start, numbered per region.

    There is no cut, so a region may hold the whole catalogue; the numbering
    does not gather it in one task.
    """
    lines = with_net(sold_between(star.sales, month_start(as_of)))
    per_product = (
        with_store(lines, star.stores, "region")
        .groupBy("region", "product_id")
        .agg(
            net_sales().alias("net_sales"),
            F.sum("quantity").alias("units"),
            F.count_distinct("store_id").alias("stores"),
        )
        .filter(F.col("net_sales") > min_net)
    )
    named = with_product(per_product, star.products, "category", "brand", "product_name")
    return (
        number_descending(named, ["region"], "net_sales", "product_id", "region_rank")
        .select(
            "region", "product_id", "category", "brand", "product_name",
            "net_sales", "units", "stores", "region_rank",
        )
        .orderBy("region", "region_rank")
    )


def regional_ranking_fast(regional: DataFrame, as_of: date, min_net: int = 1000, n: int = 10) -> DataFrame:
    """The first ``n`` per region, read from the regional summary table."""
    current = regional.filter((F.col("month") == F.lit(month_start(as_of))) & (F.col("net_sales") > min_net))
    order = [F.desc_nulls_first("net_sales"), F.asc("product_id")]
    return (
        top_per_group(current, ["region"], order, n, "region_rank")
        .select(
            "region", "product_id", "category", "brand", "product_name",
            "net_sales", "units", "stores", "region_rank",
        )
        .orderBy("region", "region_rank")
    )


def top_in_category_region(
    regional: DataFrame, as_of: date, category: str, region: str, n: int = 5
) -> DataFrame:
    """Products up to rank ``n`` of a category in a region in the month of ``as_of``; ties at the end all stay."""
    rows = regional.filter(
        (F.col("month") == F.lit(month_start(as_of)))
        & (F.col("category") == category)
        & (F.col("region") == region)
    )
    ranked = top_per_group(
        rows, ["category", "region"], [F.desc_nulls_first("net_sales")], n, "_rank", number=F.rank
    )
    return ranked.select("product_id", "product_name", "brand", "units", "net_sales").orderBy(
        F.desc_nulls_first("net_sales"), "product_id"
    )
