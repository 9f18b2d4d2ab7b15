"""Calendar parts. Plain integer arithmetic where a fact-sized table needs them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.text import col


def date_key(d: Column | str) -> Column:
    """yyyyMMdd as int, without formatting text for every fact row."""
    d = col(d)
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def date_key_of_text(iso_date: Column | str) -> Column:
    """yyyyMMdd as int from ``yyyy-MM-dd`` text."""
    return F.replace(col(iso_date), F.lit("-"), F.lit("")).try_cast("int")


def day_number(d: Column | str, first_day: Column) -> Column:
    """Running day number, 1 on ``first_day``."""
    return F.date_diff(col(d), first_day) + 1


def weekday_name(d: Column | str) -> Column:
    return F.date_format(col(d), "EEEE")


def month_short_name(d: Column | str) -> Column:
    return F.date_format(col(d), "MMM")


def weekday_sunday0(d: Column | str) -> Column:
    return F.dayofweek(col(d)) - 1


def weekday_monday0(d: Column | str) -> Column:
    return F.weekday(col(d))


def is_weekend(d: Column | str) -> Column:
    return F.weekday(col(d)).isin(5, 6)


def day_bounds(df: DataFrame, day: Column | str) -> DataFrame:
    """One row: first_day, last_day (both NULL on an empty table)."""
    day = col(day).cast("date")
    return df.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))


def day_spine(bounds: DataFrame, name: str = "full_date") -> DataFrame:
    """One row per day between the bounds, both included; none for NULL bounds."""
    days = F.sequence("first_day", "last_day", F.expr("interval 1 day"))
    return bounds.select(F.explode(days).alias(name))
