"""Date-range filters and date arithmetic.

Nothing here reads the clock: relative periods count back from an ``as_of``
date that the caller passes.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Folders of stored facts; months are numbers like 202406.
YEAR_PARTITION, MONTH_PARTITION, STOCK_MONTH = "sale_year", "sale_month", "snapshot_month"


def month_number(day: date) -> int:
    return day.year * 100 + day.month


def month_of_number(number: int) -> date:
    """First day of a month given as a number like 202406."""
    return date(number // 100, number % 100, 1)


def year_month(day: str) -> Column:
    return F.year(day) * 100 + F.month(day)


def _in_range(rows: DataFrame, day: str, folders: dict[str, Callable[[date], int]], start: date | None, end: date | None) -> DataFrame:
    """Rows of a range of dates. Spark cannot derive a filter on a folder column from one on the date, so both are stated."""
    laid_out = {column: number for column, number in folders.items() if column in rows.columns}
    if start is not None:
        rows = rows.filter(F.col(day) >= F.lit(start))
        for column, number in laid_out.items():
            rows = rows.filter(F.col(column) >= number(start))
    if end is not None:
        rows = rows.filter(F.col(day) <= F.lit(end))
        for column, number in laid_out.items():
            rows = rows.filter(F.col(column) <= number(end))
    return rows


def sold_between(sales: DataFrame, start: date | None = None, end: date | None = None) -> DataFrame:
    """Sales of an inclusive date range; of a stored table only the folders of its months are read."""
    folders = {YEAR_PARTITION: lambda d: d.year, MONTH_PARTITION: month_number}
    return _in_range(sales, "sale_date", folders, start, end)


def sold_outside(sales: DataFrame, start: date, end: date) -> DataFrame:
    """Sales before, after, or without a date; of a stored table the folders of months that lie inside the range are not read."""
    rows = sales.filter((F.col("sale_date") < F.lit(start)) | (F.col("sale_date") > F.lit(end)) | F.col("sale_date").isNull())
    month = F.col(MONTH_PARTITION)
    if MONTH_PARTITION in sales.columns:
        rows = rows.filter((month <= month_number(start)) | (month >= month_number(end)) | month.isNull())
    return rows


def snapshots_between(inventory: DataFrame, start: date | None = None, end: date | None = None) -> DataFrame:
    """Snapshots of an inclusive date range; of a stored table only the folders of its months are read."""
    return _in_range(inventory, "snapshot_date", {STOCK_MONTH: month_number}, start, end)


def calendar_days(calendar: DataFrame, start: date | None = None, end: date | None = None) -> DataFrame:
    """Calendar rows of a range, keyed for a join with sales."""
    days = calendar.withColumnRenamed("cal_date", "sale_date")
    if start is not None:
        days = days.filter(F.col("sale_date") >= F.lit(start))
    if end is not None:
        days = days.filter(F.col("sale_date") <= F.lit(end))
    return days


def days_before(as_of: date, days: int) -> date:
    return as_of - timedelta(days=days)


def month_start(day: date) -> date:
    return day.replace(day=1)


def months_before(day: date, months: int) -> date:
    """First day of the month ``months`` before the month of ``day``."""
    index = day.year * 12 + day.month - 1 - months
    return date(index // 12, index % 12 + 1, 1)


def year_span(first: int, last: int) -> tuple[date, date]:
    return date(first, 1, 1), date(last, 12, 31)


def quarter_span(year: int, quarter: int) -> tuple[date, date]:
    start = date(year, 3 * quarter - 2, 1)
    after = date(year + quarter // 4, 3 * (quarter % 4) + 1, 1)
    return start, after - timedelta(days=1)


def time_of_day(text: str) -> Column:
    """A text time as ``HH:mm:ss``; hours, minutes and seconds may have one digit, seconds may be left out. NULL if it is none."""
    parsed = F.coalesce(F.try_to_timestamp(text, F.lit("H:m:s")), F.try_to_timestamp(text, F.lit("H:m")))
    return F.date_format(parsed, "HH:mm:ss")
