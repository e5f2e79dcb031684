"""Generated calendar dimension with holidays."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class HolidayRule:
    """A holiday in ``month`` on one of ``first_day..last_day``.

    With ``iso_weekday`` set only that weekday of the range counts, which
    states "first Monday" as days 1-7 and "third Monday" as days 15-21.
    """

    name: str
    month: int
    first_day: int
    last_day: int
    iso_weekday: int | None = None

    def matches(self) -> str:
        """SQL condition on calendar columns."""
        hit = f"month = {self.month} AND day BETWEEN {self.first_day} AND {self.last_day}"
        return hit if self.iso_weekday is None else f"{hit} AND iso_weekday = {self.iso_weekday}"


# The holidays of the data model.
HOLIDAYS = (
    HolidayRule("Año Nuevo", 1, 1, 1),
    HolidayRule("Día de la Constitución", 2, 1, 7, 1),
    HolidayRule("Natalicio de Benito Juárez", 3, 15, 21, 1),
    HolidayRule("Día del Trabajo", 5, 1, 1),
    HolidayRule("Día de la Independencia", 9, 16, 16),
    HolidayRule("Día de la Revolución", 11, 15, 21, 1),
    HolidayRule("Nochebuena", 12, 24, 24),
    HolidayRule("Navidad", 12, 25, 25),
    HolidayRule("Fin de Año", 12, 31, 31),
)

NAME_WIDTH = 9


def date_series(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per day, both ends included."""
    days = F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))
    return spark.range(1, numPartitions=1).select(F.explode(days).alias("cal_date"))


def add_date_parts(days: DataFrame, padded: bool = True) -> DataFrame:
    """Calendar attributes of ``cal_date``.

    The week is the ISO week while the year is the calendar year, so the first
    days of January may carry week 52 or 53. Names are blank-padded unless
    ``padded`` is off.
    """
    def name(pattern: str) -> str:
        text = f"date_format(cal_date, '{pattern}')"
        return f"rpad({text}, {NAME_WIDTH}, ' ')" if padded else text

    return days.selectExpr(
        "cal_date",
        "dayofmonth(cal_date) AS day",
        "weekday(cal_date) + 1 AS iso_weekday",
        f"{name('EEEE')} AS day_name",
        "weekofyear(cal_date) AS iso_week",
        "month(cal_date) AS month",
        f"{name('MMMM')} AS month_name",
        "quarter(cal_date) AS quarter",
        "year(cal_date) AS year",
        "weekday(cal_date) >= 5 AS is_weekend",
        "concat('Q', quarter(cal_date), '-', year(cal_date)) AS fiscal_period",
    )


def add_holidays(days: DataFrame, rules: tuple[HolidayRule, ...] = HOLIDAYS) -> DataFrame:
    """Mark holidays. The first matching rule names the day."""
    cases = " ".join("WHEN {} THEN '{}'".format(r.matches(), r.name.replace("'", "\\'")) for r in rules)
    name = F.expr(f"CASE {cases} END") if rules else F.lit(None).cast("string")
    return days.withColumn("holiday_name", name).withColumn("is_holiday", F.col("holiday_name").isNotNull())


def calendar(
    spark: SparkSession,
    start: date = date(2021, 1, 1),
    end: date = date(2025, 12, 31),
    rules: tuple[HolidayRule, ...] = HOLIDAYS,
    padded: bool = True,
) -> DataFrame:
    columns = (
        "cal_date", "day", "iso_weekday", "day_name", "iso_week", "month", "month_name",
        "quarter", "year", "is_weekend", "is_holiday", "holiday_name", "fiscal_period",
    )
    return add_holidays(add_date_parts(date_series(spark, start, end), padded), rules).select(*columns)


def calendar_covering(
    df: DataFrame, column: str, rules: tuple[HolidayRule, ...] = HOLIDAYS, padded: bool = True
) -> DataFrame:
    """Calendar of the whole years that the dates of a column fall in."""
    bounds = df.agg(F.min(column).alias("first"), F.max(column).alias("last"))
    start = F.trunc("first", "YEAR")
    end = F.date_sub(F.add_months(F.trunc("last", "YEAR"), 12), 1)
    days = bounds.select(F.explode(F.sequence(start, end, F.expr("interval 1 day"))).alias("cal_date"))
    return add_holidays(add_date_parts(days, padded), rules)


def calendar_summary(cal: DataFrame) -> DataFrame:
    """Days, weekend days and holidays per year."""
    return (
        cal.groupBy("year")
        .agg(
            F.count("*").alias("days"),
            F.count_if("is_weekend").alias("weekend_days"),
            F.count_if("is_holiday").alias("holidays"),
        )
        .orderBy("year")
    )


def holiday_list(cal: DataFrame) -> DataFrame:
    return cal.filter("is_holiday").select("year", "cal_date", "holiday_name", "day_name").orderBy("year", "cal_date")
