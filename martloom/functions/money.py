"""Money stays decimal; only ratios leave as double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martloom.functions.text import col


def line_total(quantity: Column | str, unit_price: Column | str) -> Column:
    """NULL when the amount has no room in the type."""
    return F.round(col(quantity) * col(unit_price), 2).try_cast("decimal(12,2)")


def net_revenue(unit_price: Column | str, quantity: Column | str, discount: Column | str) -> Column:
    net = col(unit_price) * col(quantity) * (F.lit(1) - col(discount))
    return F.round(net, 2).try_cast("decimal(14,2)")


def line_cost(unit_cost: Column | str, quantity: Column | str) -> Column:
    return F.round(col(unit_cost) * col(quantity), 2).try_cast("decimal(14,2)")


def cents(amount: Column | str) -> Column:
    """An amount of two decimals in whole cents; sums of them are plain additions of 64-bit numbers."""
    return (col(amount) * F.lit(100)).cast("bigint")


def from_cents(total: Column) -> Column:
    return (total.cast("decimal(20,0)") / F.lit(100)).cast("decimal(24,2)")


def ratio(part: Column, whole: Column, digits: int = 6) -> Column:
    """part / whole; NULL when the denominator is zero or missing."""
    return F.round(F.try_divide(part.cast("double"), whole.cast("double")), digits)


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    return F.round(F.try_divide(part.cast("double"), whole.cast("double")) * 100, digits)


def growth(now: Column, before: Column) -> Column:
    """(now - before) / before as exact decimals, blank without a prior value."""
    return ratio(now - before, before)


def growth_percent(now: Column, before: Column) -> Column:
    return percent(now - before, before)
