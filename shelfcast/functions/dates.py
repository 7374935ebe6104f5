"""Calendar expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_date(text: Column, pattern: str = "yyyy-MM-dd") -> Column:
    return F.to_date(text, pattern)


def days_since(date: Column, origin: Column) -> Column:
    return F.datediff(date, origin)


def absolute_day(date: Column) -> Column:
    """Days since 1970-01-01."""
    return F.unix_date(date)


def is_fifteenth(date: Column) -> Column:
    return (F.dayofmonth(date) == 15).cast("int")


def is_month_end(date: Column) -> Column:
    return (F.last_day(date) == date).cast("int")


def weekday_name(date: Column) -> Column:
    return F.date_format(date, "EEEE")


def circular(value: Column, period: float) -> tuple[Column, Column]:
    """Sine and cosine of a place in a cycle."""
    angle = value * F.lit(2 * math.pi / period)
    return F.sin(angle), F.cos(angle)


def calendar_shift(date: Column, count: int, unit: str) -> Column:
    """The date ``count`` days, weeks, months or years away."""
    if unit in ("day", "week"):
        return F.date_add(date, count * (7 if unit == "week" else 1))
    if unit in ("month", "year"):
        return F.add_months(date, count * (12 if unit == "year" else 1))
    raise ValueError(f"unknown calendar unit {unit!r}")


def date_parts(date: Column) -> dict[str, Column]:
    """The features a model gets in place of the date, the origin-based one apart."""
    return {
        "day_of_year": F.dayofyear(date),
        "day_of_month": F.dayofmonth(date),
        "day_of_week": F.weekday(date),  # Monday is 0
        "is_15th": is_fifteenth(date),
        "is_last_day_of_month": is_month_end(date),
    }


def replace_date(df: DataFrame, origin: Column, date: str = "date") -> DataFrame:
    """Trade the date for day numbers and pay-day flags; ``origin`` is the first training date."""
    column = F.col(date)
    features = {"days_since_start": days_since(column, origin), **date_parts(column)}
    return df.withColumns(features).drop(date)


def sales_date_features(df: DataFrame, date: str = "date_of_sales") -> DataFrame:
    """Day features for exploration: numbers for order, names and texts for display."""
    column = F.col(date)
    last = is_month_end(column)
    return df.withColumns({
        "day_of_year_of_sales": F.dayofyear(column),
        "day_of_month_of_sales": F.dayofmonth(column),
        "is_day_of_sales_last_day_of_month_number": last,
        "is_day_of_sales_last_day_of_month": F.initcap((last == 1).cast("string")),
        "day_of_week_of_sales_as_number": F.weekday(column),
        "day_of_week_of_sales": weekday_name(column),
    })
