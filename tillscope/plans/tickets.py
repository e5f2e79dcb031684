"""Average-ticket analysis.

Lines are first reduced to one row per ticket and group. Tickets of a group
are then plain rows, so counting them needs no distinct aggregate.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.functions.measures import NET_X100, net_sales, ratio, with_net
from tillscope.functions.periods import calendar_days, sold_between, sold_outside, time_of_day
from tillscope.operators.joins import with_day, with_store
from tillscope.operators.quantile import weighted_quantile
from tillscope.plans.sales import avg_line_value
from tillscope.sources.shared import materialized
from tillscope.star import Star


def _ticket_lines(star: Star, start: date | None = None, end: date | None = None) -> DataFrame:
    return with_net(sold_between(star.sales, start, end)).filter(F.col("ticket_id").isNotNull())


def _per_ticket(lines: DataFrame, *groups: str) -> DataFrame:
    return lines.groupBy("ticket_id", *groups).agg(
        F.count("*").alias("lines"), F.sum(NET_X100).alias(NET_X100)
    )


def _whole_tickets(star: Star, tickets: DataFrame, start: date, end: date, across_dates: bool) -> DataFrame:
    """Line count and value of each ticket of the range over all its lines, from the range's ``tickets`` by group.

    ``across_dates`` counts lines outside the range too: they are read, cut to
    the tickets of the range, and added to the totals of the range's own lines.
    Where a ticket is known to lie on one date, switching it off saves reading
    the other years.
    """
    lines = tickets.select("ticket_id", "lines", NET_X100)
    if across_dates:
        outside = with_net(sold_outside(star.sales, start, end)).filter(F.col("ticket_id").isNotNull())
        others = outside.join(tickets.select("ticket_id").distinct(), "ticket_id", "left_semi")
        lines = lines.unionByName(others.select("ticket_id", F.lit(1).cast("long").alias("lines"), NET_X100))
    return lines.groupBy("ticket_id").agg(
        F.sum("lines").alias("ticket_lines"), F.sum(NET_X100).alias("ticket_net_x100")
    )


def weekly_ticket_by_format(
    star: Star, start: date, end: date, per_ticket: bool = False, across_dates: bool = True
) -> DataFrame:
    """Tickets, net sales and items per ticket by ISO week and store format.

    The mean number of items is taken over lines, so a ticket of n lines
    weighs n times; ``per_ticket`` gives every ticket the same weight. The
    range's lines are read once: its tickets are stored in the shared folder
    while the plan is built.
    """
    days = calendar_days(star.calendar, start, end)
    lines = with_day(_ticket_lines(star, start, end), days, "year", "iso_week")
    lines = with_store(lines, star.stores, "format")
    groups = materialized(_per_ticket(lines, "year", "iso_week", "format"))
    tickets = groups.join(_whole_tickets(star, groups, start, end, across_dates), "ticket_id")
    weight = F.lit(1) if per_ticket else F.col("lines")
    return (
        tickets.groupBy("year", "iso_week", "format")
        .agg(
            F.count("*").alias("tickets"),
            net_sales().alias("net_sales"),
            ratio(net_sales(), F.count("*")).alias("net_per_ticket"),
            ratio(F.sum(weight * F.col("ticket_lines")), F.sum(weight)).alias("avg_items"),
        )
        .orderBy(F.desc("year"), F.desc("iso_week"), F.desc_nulls_first("net_per_ticket"))
    )


def monthly_ticket_by_region(
    star: Star, start: date, end: date, per_ticket: bool = False, across_dates: bool = True
) -> DataFrame:
    """Tickets, net sales and median ticket by month and region.

    The median is taken over lines unless ``per_ticket`` is set. The range's
    lines are read once: its tickets are stored in the shared folder while the
    plan is built.
    """
    keys = ["year", "month", "month_name", "region"]
    days = calendar_days(star.calendar, start, end)
    lines = with_day(_ticket_lines(star, start, end), days, "year", "month", "month_name")
    lines = with_store(lines, star.stores, "region")
    groups = materialized(_per_ticket(lines, *keys))
    # Totals and medians read tickets more than once; lines are read once for them.
    valued = materialized(
        groups.join(_whole_tickets(star, groups, start, end, across_dates), "ticket_id").withColumn(
            "weight", F.lit(1).cast("long") if per_ticket else F.col("lines")
        )
    )
    totals = valued.groupBy(*keys).agg(
        F.count("*").alias("tickets"),
        net_sales().alias("net_sales"),
        ratio(net_sales(), F.count("*")).alias("net_per_ticket"),
    )
    medians = weighted_quantile(valued, keys, "ticket_net_x100", "weight", "median_x100")
    return (
        totals.join(medians, keys, "left")
        .withColumn("median_ticket", F.col("median_x100") / F.lit(100.0))
        .drop("median_x100")
        .orderBy(F.desc("year"), F.desc("month"), F.desc_nulls_first("net_per_ticket"))
    )


def hourly_tickets(star: Star, start: date, end: date) -> DataFrame:
    """Tickets and net sales by hour of day and store format.

    Hours may have one digit or two; lines whose time is missing or no time of
    day are left out.
    """
    lines = (
        _ticket_lines(star, start, end)
        .withColumn("hour", F.substring(time_of_day("sale_time"), 1, 2).cast("int"))
        .filter(F.col("hour").isNotNull())
    )
    tickets = _per_ticket(with_store(lines, star.stores, "format"), "hour", "format")
    return (
        tickets.groupBy("hour", "format")
        .agg(
            F.count("*").alias("tickets"),
            net_sales().alias("net_sales"),
            ratio(net_sales(), F.count("*")).alias("net_per_ticket"),
        )
        .orderBy("hour", "format")
    )


def ticket_by_format(star: Star, start: date, end: date) -> DataFrame:
    """Mean line value, net per ticket and units per ticket by store format."""
    lines = with_store(with_net(sold_between(star.sales, start, end)), star.stores, "format")
    tickets = F.count_distinct("ticket_id")
    return (
        lines.groupBy("format")
        .agg(
            avg_line_value().alias("avg_line_value"),
            ratio(net_sales(), tickets).alias("net_per_ticket"),
            ratio(F.sum("quantity"), tickets).alias("units_per_ticket"),
        )
        .orderBy(F.desc_nulls_last("net_per_ticket"))
    )
