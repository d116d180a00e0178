"""Calendar attributes of a date."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

WEEKEND = (0, 6)  # day_of_week counts from 0 = Sunday


def date_key(day: Column) -> Column:
    return F.date_format(day, "yyyyMMdd").cast("int")


def calendar_columns(day: Column) -> dict[str, Column]:
    day_of_week = F.dayofweek(day) - 1
    return {
        "date_day": day,
        "date_key": date_key(day),
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month": F.month(day),
        "month_name": F.monthname(day),
        "day_of_month": F.day(day),
        "day_of_week": day_of_week,
        "day_name": F.dayname(day),
        "week_of_year": F.weekofyear(day),
        "is_weekend": day_of_week.isin(*WEEKEND),
    }
