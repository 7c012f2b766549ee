"""Dates, months and their integer keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(day: Column) -> Column:
    """YYYYMMDD as an integer."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def month_key(day: Column) -> Column:
    """Key of the first day of the month."""
    return (F.year(day) * 10000 + F.month(day) * 100 + 1).cast("int")


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def day_of_key(key: Column) -> Column:
    """Date of a YYYYMMDD key."""
    return F.make_date(
        F.floor(key / 10000).cast("int"), F.floor(key % 10000 / 100).cast("int"), key % 100
    )


def calendar_columns(day: Column) -> list[Column]:
    """Attributes of a calendar day; weekdays count from Monday = 1."""
    weekday = F.weekday(day) + 1
    return [
        date_key(day).alias("date_key"),
        day.alias("calendar_date"),
        month_start(day).alias("calendar_month"),
        F.year(day).alias("calendar_year"),
        F.quarter(day).alias("calendar_quarter"),
        F.dayofmonth(day).alias("day_of_month"),
        weekday.alias("day_of_week"),
        (weekday >= 6).alias("is_weekend"),
    ]


def month_cohort(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def tenure_months(day: Column, reference: Column) -> Column:
    """Calendar months between two days; the day of the month does not count."""
    return (
        (F.year(reference) - F.year(day)) * 12 + F.month(reference) - F.month(day)
    ).cast("int")


def month_of_text(year_month: Column) -> Column:
    """First day of a month given as YYYY-MM."""
    return F.to_date(F.concat(year_month, F.lit("-01")), "yyyy-MM-dd")


def local_day(instant: Column, zone: str = "Asia/Seoul") -> Column:
    """Calendar day of an instant in the business time zone (session zone: UTC)."""
    return F.from_utc_timestamp(instant, zone).cast("date")


def last_complete_day(instant: Column, zone: str = "Asia/Seoul") -> Column:
    return F.date_sub(local_day(instant, zone), 1)
