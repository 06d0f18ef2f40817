"""Calendar expressions. Day of week counts 1 = Sunday to 7 = Saturday."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sunday and Saturday.
WEEKEND_DAYS = (1, 7)


def is_weekend(day: Column) -> Column:
    return F.dayofweek(day).isin(*WEEKEND_DAYS)


def date_key(day: Column) -> Column:
    """Date as a yyyymmdd integer."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def calendar_attributes(day: Column) -> list[Column]:
    """Columns of the date dimension other than the date itself."""
    return [
        date_key(day).alias("date_key"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.quarter(day).alias("quarter"),
        F.dayofweek(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.date_format(day, "MMMM").alias("month_name"),
        is_weekend(day).alias("is_weekend"),
        F.weekofyear(day).alias("week_of_year"),
    ]


def to_moment(value: Column, strict: bool) -> Column:
    """Timestamp from text or timestamp; unreadable text raises, or gives null if not strict."""
    return F.to_timestamp(value) if strict else F.try_to_timestamp(value.cast("string"))


def convert(value: Column, type_name: str, strict: bool) -> Column:
    """Cast; an unreadable value raises, or gives null if not strict."""
    return value.cast(type_name) if strict else value.try_cast(type_name)
