from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from shelfline.functions import dates
from shelfline.rules import calendar


def attributes(spark, *days):
    df = spark.createDataFrame([(d,) for d in days], "date_day DATE")
    return {r["full_date"]: r for r in calendar.build_dim_date(df).collect()}


@pytest.mark.parametrize(
    ("day", "name"),
    [
        (date(2018, 11, 22), "Thanksgiving"),
        (date(2018, 11, 23), "Black Friday"),
        (date(2018, 11, 26), "Cyber Monday"),
        (date(2024, 11, 28), "Thanksgiving"),
        (date(2024, 12, 2), "Cyber Monday"),
        (date(2024, 11, 25), None),
        (date(2024, 1, 1), "New Year Day"),
        (date(2024, 7, 4), "Independence Day"),
        (date(2024, 12, 26), "Boxing Day"),
        (date(2024, 2, 29), None),
    ],
)
def test_holidays(spark, day, name):
    row = attributes(spark, day)[day]
    assert row["holiday_name"] == name
    assert row["is_holiday"] == (name is not None)
    assert row["is_cyber_monday"] == (name == "Cyber Monday")


def test_thanksgiving_is_the_fourth_thursday_of_every_year(spark):
    years = spark.range(1990, 2040).select(F.make_date("id", F.lit(5), F.lit(17)).alias("d"))
    for r in years.select(dates.thanksgiving(F.col("d")).alias("t")).collect():
        first = date(r.t.year, 11, 1)
        thursdays = [first + timedelta(n) for n in range(30) if (first + timedelta(n)).weekday() == 3]
        assert r.t == thursdays[3]


def test_year_ends(spark):
    known = attributes(spark, date(2024, 5, 31), date(2024, 6, 1), date(2024, 1, 31), date(2024, 12, 31))
    assert known[date(2024, 5, 31)]["fiscal_quarter_name"] == "FQ4-FY2024"
    assert known[date(2024, 6, 1)]["fiscal_quarter_name"] == "FQ1-FY2025"
    assert known[date(2024, 6, 1)]["fiscal_week_num"] == 1
    assert known[date(2024, 5, 31)]["fiscal_week_num"] == 49
    assert known[date(2024, 1, 31)]["retail_year_num"] == 2023
    last = known[date(2024, 12, 31)]
    assert (last["retail_week_num"], last["retail_period_num"]) == (53, 14)
    assert last["last_day_of_quarter"] == date(2024, 12, 31)
    assert last["quarter_name"] == "Q4-2024"
    assert last["season"] == "HOLIDAY"


def test_weekdays_count_from_sunday(spark):
    known = attributes(spark, date(2024, 6, 2), date(2024, 6, 8))
    assert known[date(2024, 6, 2)]["day_of_week_num"] == 1
    assert known[date(2024, 6, 8)]["day_of_week_num"] == 7
    assert known[date(2024, 6, 8)]["is_weekend"]


def test_date_keys(spark):
    df = spark.createDataFrame([(20240229,), (20230229,), (None,)], "sk INT")
    got = df.select(dates.date_from_sk(F.col("sk"), strict=False).alias("d")).collect()
    assert [r.d for r in got] == [date(2024, 2, 29), None, None]


def test_shares_of_days_add_up(spark):
    days = calendar.days_between(spark, date(2024, 1, 1), date(2024, 12, 31))
    weights = {r.full_date: r.weight for r in calendar.seasonality(calendar.build_dim_date(days)).collect()}
    assert sum(weights.values()) == pytest.approx(1.0)
    black_friday, plain = weights[date(2024, 11, 29)], weights[date(2024, 3, 6)]
    assert black_friday / plain == pytest.approx(4.5)
