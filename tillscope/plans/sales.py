"""Daily, weekly and per-store sales."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillscope.functions.measures import NET_X100, net_sales, ratio, with_net
from tillscope.functions.periods import calendar_days, days_before, sold_between
from tillscope.operators.joins import with_day, with_store
from tillscope.star import Star


def avg_line_value():
    """Mean net value of a sale line (not of a ticket)."""
    return ratio(net_sales(), F.count(NET_X100))


def _by_day_and_chain(lines: DataFrame) -> DataFrame:
    return (
        lines.groupBy("sale_date", "chain")
        .agg(
            F.count_distinct("ticket_id").alias("tickets"),
            F.sum("quantity").alias("units"),
            net_sales().alias("net_sales"),
            avg_line_value().alias("avg_line_value"),
        )
        .orderBy(F.desc("sale_date"), F.desc_nulls_first("net_sales"))
    )


def daily_sales_by_chain(star: Star, start: date, end: date) -> DataFrame:
    """Tickets, units and net sales per calendar day and chain."""
    lines = with_net(sold_between(star.sales, start, end))
    lines = with_day(lines, calendar_days(star.calendar, start, end))
    return _by_day_and_chain(with_store(lines, star.stores, "chain"))


def daily_sales_by_chain_quarter(star: Star, start: date, end: date) -> DataFrame:
    """The same figures without the calendar: days outside it are kept."""
    lines = with_net(sold_between(star.sales, start, end))
    return _by_day_and_chain(with_store(lines, star.stores, "chain"))


def daily_net_by_chain(star: Star, start: date, end: date) -> DataFrame:
    """Smoke query after a load: net sales per day and chain."""
    lines = with_net(sold_between(star.sales, start, end))
    return (
        with_store(lines, star.stores, "chain")
        .groupBy("sale_date", "chain")
        .agg(net_sales().alias("net_sales"))
        .orderBy(F.desc("sale_date"), F.desc_nulls_first("net_sales"))
    )


def weekly_sales_trend(star: Star, as_of: date, weeks: int = 12) -> DataFrame:
    """Net sales, active stores and tickets per ISO week and chain."""
    start = days_before(as_of, 7 * weeks)
    lines = with_net(sold_between(star.sales, start))
    lines = with_day(lines, calendar_days(star.calendar, start), "year", "iso_week")
    return (
        with_store(lines, star.stores, "chain")
        .groupBy("year", "iso_week", "chain")
        .agg(
            net_sales().alias("net_sales"),
            F.count_distinct("store_id").alias("active_stores"),
            F.count_distinct("ticket_id").alias("tickets"),
        )
        .orderBy(F.desc("year"), F.desc("iso_week"), F.desc_nulls_first("net_sales"))
    )


def store_daily_average(star: Star, start: date, end: date) -> DataFrame:
    """Per store: net sales, active days and mean sale per active day.

    Grouping by day first makes the number of active days a plain count.
    """
    per_day = (
        with_net(sold_between(star.sales, start, end))
        .groupBy("store_id", "sale_date")
        .agg(F.sum(NET_X100).alias(NET_X100))
    )
    per_store = per_day.groupBy("store_id").agg(
        net_sales().alias("net_sales"), F.count("sale_date").alias("active_days")
    )
    return with_store(
        per_store.withColumn("avg_daily_sale", ratio("net_sales", "active_days")),
        star.stores, "chain", "store_name", "format", "region",
    )


def store_ranking(star: Star, start: date, end: date) -> DataFrame:
    """Rank and percentile of every store within its chain.

    The windows run over one row per store.
    """
    chain = Window.partitionBy("chain")
    average = F.col("avg_daily_sale")
    return (
        store_daily_average(star, start, end)
        .withColumn("chain_rank", F.rank().over(chain.orderBy(average.desc_nulls_first())))
        .withColumn("percentile", F.percent_rank().over(chain.orderBy(average.asc_nulls_last())))
        .select(
            "chain", "store_id", "store_name", "format", "region",
            "net_sales", "avg_daily_sale", "chain_rank", "percentile",
        )
        .orderBy("chain", "chain_rank")
    )
