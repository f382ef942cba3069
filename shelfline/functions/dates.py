"""Calendar columns. Every function maps a date column to a column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfline import params


def date_from_sk(sk: Column, strict: bool = True) -> Column:
    """Integer YYYYMMDD to a date; ``strict=False`` gives NULL for a bad key."""
    text = sk.cast("string")
    return F.to_date(text, "yyyyMMdd") if strict else F.try_to_date(text, "yyyyMMdd")


def date_to_sk(day: Column) -> Column:
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def period_start(day: Column, grain: str) -> Column:
    """First day of the year, quarter, month or week; the day itself for day."""
    return day if grain == "day" else F.trunc(day, grain).cast("date")


def quarter_end(day: Column) -> Column:
    return F.date_sub(F.add_months(F.trunc(day, "quarter"), 3), 1)


def quarter_label(day: Column) -> Column:
    return F.concat(F.lit("Q"), F.quarter(day).cast("string"), F.lit("-"), F.year(day).cast("string"))


def day_ordinal(day: Column) -> Column:
    """Days since 1970-01-01, the order column of calendar-range windows."""
    return F.unix_date(day)


# --- fiscal and retail years -------------------------------------------------

def fiscal_year(day: Column, first_month: int = params.FISCAL_YEAR_FIRST_MONTH) -> Column:
    return F.year(day) + F.when(F.month(day) >= first_month, 1).otherwise(0)


def fiscal_month(day: Column, first_month: int = params.FISCAL_YEAR_FIRST_MONTH) -> Column:
    return F.pmod(F.month(day) - first_month, F.lit(12)) + 1


def _int_div(value: Column, by: int) -> Column:
    return F.floor(value / by).cast("int")


def fiscal_quarter(day: Column, first_month: int = params.FISCAL_YEAR_FIRST_MONTH) -> Column:
    return _int_div(fiscal_month(day, first_month) - 1, 3) + 1


def fiscal_week(day: Column, first_month: int = params.FISCAL_YEAR_FIRST_MONTH) -> Column:
    """Four numbered weeks per fiscal month; days 29 and later fall in a fifth."""
    return (fiscal_month(day, first_month) - 1) * 4 + _int_div(F.dayofmonth(day) - 1, 7) + 1


def fiscal_quarter_label(day: Column, first_month: int = params.FISCAL_YEAR_FIRST_MONTH) -> Column:
    return F.concat(
        F.lit("FQ"), fiscal_quarter(day, first_month).cast("string"),
        F.lit("-FY"), fiscal_year(day, first_month).cast("string"),
    )


def retail_year(day: Column) -> Column:
    return F.year(day) - F.when(F.month(day) == 1, 1).otherwise(0)


def retail_week(day: Column) -> Column:
    return _int_div(F.dayofyear(day) - 1, 7) + 1


def retail_period(day: Column) -> Column:
    return _int_div(retail_week(day) - 1, 4) + 1


# --- seasons, holidays, flags --------------------------------------------------

def season(day: Column) -> Column:
    months = F.month(day)
    branches = F.lit(params.DEFAULT_SEASON)
    for name, members in params.SEASON_MONTHS.items():
        branches = F.when(months.isin(*members), name).otherwise(branches)
    return branches


def thanksgiving(day: Column) -> Column:
    """Fourth Thursday of November in the year of ``day``."""
    last_of_october = F.make_date(F.year(day), F.lit(10), F.lit(31))
    return F.date_add(F.next_day(last_of_october, "Thu"), 21)


def is_black_friday(day: Column) -> Column:
    return day == F.date_add(thanksgiving(day), 1)


def is_cyber_monday(day: Column) -> Column:
    return day == F.date_add(thanksgiving(day), 4)


def holiday_name(day: Column) -> Column:
    """Movable holidays win over the fixed ones; NULL on ordinary days."""
    name = (
        F.when(day == thanksgiving(day), "Thanksgiving")
        .when(is_black_friday(day), "Black Friday")
        .when(is_cyber_monday(day), "Cyber Monday")
    )
    for (month, dom), label in params.FIXED_HOLIDAYS.items():
        name = name.when((F.month(day) == month) & (F.dayofmonth(day) == dom), label)
    return name


def is_weekend(day: Column) -> Column:
    return F.dayofweek(day).isin(1, 7)


def is_back_to_school(day: Column) -> Column:
    return F.month(day).isin(7, 8) & (F.dayofmonth(day) >= 15)


def calendar_columns(day: Column, names: Sequence[str] = ()) -> dict[str, Column]:
    """The named attributes of the date dimension; by default all, in table order."""
    attributes = {
        "date_sk": lambda: date_to_sk(day),
        "full_date": lambda: day,
        "day_of_week_num": lambda: F.dayofweek(day).cast("tinyint"),
        "day_of_week_name": lambda: F.date_format(day, "EEEE"),
        "day_of_week_abbr": lambda: F.date_format(day, "EEE"),
        "day_of_month": lambda: F.dayofmonth(day).cast("tinyint"),
        "day_of_year": lambda: F.dayofyear(day).cast("smallint"),
        "week_of_year": lambda: F.weekofyear(day).cast("tinyint"),
        "iso_week_number": lambda: F.weekofyear(day).cast("tinyint"),
        "month_num": lambda: F.month(day).cast("tinyint"),
        "month_name": lambda: F.date_format(day, "MMMM"),
        "month_abbr": lambda: F.date_format(day, "MMM"),
        "month_year": lambda: F.date_format(day, "MMM-yyyy"),
        "quarter_num": lambda: F.quarter(day).cast("tinyint"),
        "quarter_name": lambda: quarter_label(day),
        "year_num": lambda: F.year(day).cast("smallint"),
        "first_day_of_month": lambda: period_start(day, "month"),
        "last_day_of_month": lambda: F.last_day(day),
        "first_day_of_quarter": lambda: period_start(day, "quarter"),
        "last_day_of_quarter": lambda: quarter_end(day),
        "fiscal_week_num": lambda: fiscal_week(day).cast("tinyint"),
        "fiscal_month_num": lambda: fiscal_month(day).cast("tinyint"),
        "fiscal_quarter_num": lambda: fiscal_quarter(day).cast("tinyint"),
        "fiscal_year_num": lambda: fiscal_year(day).cast("smallint"),
        "fiscal_quarter_name": lambda: fiscal_quarter_label(day),
        "retail_period_num": lambda: retail_period(day).cast("tinyint"),
        "retail_week_num": lambda: retail_week(day).cast("smallint"),
        "retail_year_num": lambda: retail_year(day).cast("smallint"),
        "is_weekday": lambda: ~is_weekend(day),
        "is_weekend": lambda: is_weekend(day),
        "is_holiday": lambda: holiday_name(day).isNotNull(),
        "holiday_name": lambda: holiday_name(day),
        "is_black_friday": lambda: is_black_friday(day),
        "is_cyber_monday": lambda: is_cyber_monday(day),
        "is_back_to_school": lambda: is_back_to_school(day),
        "season": lambda: season(day),
    }
    return {n: attributes[n]() for n in names or attributes}
