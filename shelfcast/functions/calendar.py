"""Calendar expressions over one date column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def calendar_columns(date: Column) -> dict[str, Column]:
    """Date parts and flags; weeks are ISO, Monday is day 0."""
    weekday = F.weekday(date)
    return {
        "year": F.year(date),
        "month": F.month(date),
        "week": F.weekofyear(date),
        "day": F.dayofmonth(date),
        "dayofweek": weekday,
        "quarter": F.quarter(date),
        "is_weekend": (weekday >= 5).cast("int"),
        "is_month_start": (F.dayofmonth(date) == 1).cast("int"),
        "is_month_end": (date == F.last_day(date)).cast("int"),
    }


def cyclic_columns(date: Column) -> dict[str, Column]:
    """Weekday and month as points on the unit circle."""
    day = 2 * F.pi() * F.weekday(date) / 7
    month = 2 * F.pi() * (F.month(date) - 1) / 12
    return {
        "dow_sin": F.sin(day),
        "dow_cos": F.cos(day),
        "month_sin": F.sin(month),
        "month_cos": F.cos(month),
    }


def special_day_columns(date: Column) -> dict[str, Column]:
    """Christmas, New Year and the Friday of 23-29 November."""
    def falls_on(month: int, day: int) -> Column:
        return ((F.month(date) == month) & (F.dayofmonth(date) == day)).cast("int")

    friday = (F.month(date) == 11) & (F.weekday(date) == 4) & F.dayofmonth(date).between(23, 29)
    return {
        "is_christmas": falls_on(12, 25),
        "is_newyear": falls_on(1, 1),
        "is_black_friday": friday.cast("int"),
    }


def week_end(date: Column) -> Column:
    """Sunday that closes the week of `date`."""
    return F.date_add(F.to_date(F.date_trunc("week", date)), 6)


def month_end(date: Column) -> Column:
    return F.last_day(date)
