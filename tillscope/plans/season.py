"""Seasonality, holidays and weekdays."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillscope.functions.measures import NET_X100, money, net_sales, ratio, real, with_net
from tillscope.functions.periods import calendar_days, sold_between, year_span
from tillscope.operators.joins import with_day, with_product
from tillscope.star import Star


def _lines_of_years(star: Star, year_from: int, year_to: int, *columns: str) -> DataFrame:
    start, end = year_span(year_from, year_to)
    days = calendar_days(star.calendar, start, end).filter(F.col("year").between(year_from, year_to))
    return with_day(with_net(sold_between(star.sales, start, end)), days, *columns)


def seasonality_index(star: Star, year_from: int, year_to: int) -> DataFrame:
    """Net sales per category and month against the category's monthly mean."""
    per_product = (
        _lines_of_years(star, year_from, year_to, "month", "month_name")
        .groupBy("product_id", "month", "month_name")
        .agg(F.sum(NET_X100).alias(NET_X100))
    )
    category = Window.partitionBy("category")
    mean = ratio(F.sum("net_sales").over(category), F.count("net_sales").over(category))
    return (
        with_product(per_product, star.products, "category")
        .groupBy("category", "month", "month_name")
        .agg(net_sales().alias("net_sales"))
        .withColumn("category_mean", mean)
        .withColumn("seasonality_index", ratio("net_sales", "category_mean"))
        .orderBy("category", "month")
    )


def holiday_impact(star: Star, year_from: int, year_to: int, corrected: bool = False) -> DataFrame:
    """Holiday sales against the mean regular weekday.

    The figures to match pair every holiday line with every regular day, so
    holiday sales (and the factor) come out multiplied by the number of
    regular days. That number is applied as a factor instead of building the
    pairs; ``corrected`` leaves it out. All figures come from one aggregate
    with at most one row per calendar day, over which the windows run.
    """
    per_day = (
        _lines_of_years(star, year_from, year_to, "holiday_name", "day_name", "is_holiday", "is_weekend")
        .groupBy("sale_date", "holiday_name", "day_name", "is_holiday", "is_weekend")
        .agg(F.sum(NET_X100).alias(NET_X100))
    )
    everything = Window.partitionBy()
    regular = ~F.col("is_holiday") & ~F.col("is_weekend")
    regular_net = F.sum(F.when(regular, F.col(NET_X100))).over(everything)
    regular_days = F.count(F.when(regular, F.col(NET_X100))).over(everything)
    listed_days = F.count_if(regular).over(everything)
    net = real(money(F.col(NET_X100)))
    return (
        per_day.withColumn("regular_mean", ratio(money(regular_net), regular_days))
        .withColumn("holiday_sales", net if corrected else net * listed_days)
        .filter("is_holiday")
        .filter(F.lit(True) if corrected else F.col("regular_mean").isNotNull())
        .withColumn("lift_factor", ratio("holiday_sales", "regular_mean"))
        .select("holiday_name", "sale_date", "day_name", "holiday_sales", "regular_mean", "lift_factor")
        .orderBy(F.desc_nulls_first("lift_factor"))
    )


def sales_by_weekday(star: Star, year_from: int, year_to: int) -> DataFrame:
    """Net sales, active days and mean daily sale by quarter and weekday."""
    per_day = (
        _lines_of_years(star, year_from, year_to, "quarter", "iso_weekday", "day_name")
        .groupBy("sale_date", "quarter", "iso_weekday", "day_name")
        .agg(F.sum(NET_X100).alias(NET_X100), F.sum("quantity").alias("quantity"))
    )
    return (
        per_day.groupBy("quarter", "iso_weekday", "day_name")
        .agg(
            F.count("*").alias("days"),
            F.sum("quantity").alias("units"),
            net_sales().alias("net_sales"),
            ratio(net_sales(), F.count("*")).alias("avg_daily_sale"),
        )
        .orderBy("quarter", "iso_weekday")
    )
