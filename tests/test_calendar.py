from pyspark.sql import functions as F

from tests.helpers import D, rows
from tillscope.operators.calendar import calendar, calendar_covering, calendar_summary, holiday_list


def test_five_years_have_nine_holidays_each(spark):
    summary = calendar_summary(calendar(spark)).collect()
    assert [r["year"] for r in summary] == [2021, 2022, 2023, 2024, 2025]
    assert sum(r["days"] for r in summary) == 1826
    assert all(r["holidays"] == 9 for r in summary)


def test_iso_week_stays_with_calendar_year(spark):
    cal = calendar(spark, D("2020-12-31"), D("2021-01-04"))
    assert rows(cal.orderBy("cal_date"), "year", "iso_week", "iso_weekday") == [
        (2020, 53, 4), (2021, 53, 5), (2021, 53, 6), (2021, 53, 7), (2021, 1, 1)
    ]


def test_names_are_padded_unless_asked(spark):
    day = D("2024-02-29")
    assert rows(calendar(spark, day, day), "day_name", "month_name", "fiscal_period") == [
        ("Thursday ", "February ", "Q1-2024")
    ]
    assert rows(calendar(spark, day, day, padded=False), "day_name", "month_name") == [("Thursday", "February")]


def test_floating_holidays(spark):
    listed = holiday_list(calendar(spark, D("2024-01-01"), D("2024-12-31")))
    dates = {r["holiday_name"]: r["cal_date"] for r in listed.collect()}
    assert dates["Día de la Constitución"] == D("2024-02-05")
    assert dates["Natalicio de Benito Juárez"] == D("2024-03-18")
    assert dates["Día de la Revolución"] == D("2024-11-18")
    assert len(dates) == 9


def test_calendar_covers_whole_years_of_a_column(spark):
    df = spark.createDataFrame([(D("2023-05-05"),), (D("2024-02-01"),)], "d date")
    span = calendar_covering(df, "d").agg(F.min("cal_date"), F.max("cal_date"), F.count("*")).first()
    assert tuple(span) == (D("2023-01-01"), D("2024-12-31"), 731)
