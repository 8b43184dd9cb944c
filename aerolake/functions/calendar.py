"""Calendar parts of a date or timestamp."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def us_week(col) -> Column:
    """Week of year where week 1 holds 1 January and weeks start on Sunday
    (``datepart(week)`` with the default first weekday), unlike ISO weeks."""
    d = F.to_date(_c(col))
    jan1_dow = F.dayofweek(F.trunc(d, "year"))          # Sunday = 1
    return (F.floor((F.dayofyear(d) + jan1_dow - 2) / 7) + 1).cast("int")


def quarter_name(col) -> Column:
    return F.concat(F.lit("Q"), F.quarter(_c(col)).cast("string"))


def calendar_parts(col) -> list[Column]:
    """flight_date, year, quarter label, month, US week, day, weekday (Sun=1)."""
    c = _c(col)
    return [
        F.to_date(c).alias("flight_date"),
        F.year(c).alias("year_num"),
        quarter_name(c).alias("quarter_name"),
        F.month(c).alias("month_num"),
        us_week(c).alias("week_of_year"),
        F.dayofmonth(c).alias("day_num"),
        F.dayofweek(c).alias("day_of_week_num"),
    ]
